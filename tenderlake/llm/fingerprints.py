"""Homomorphic multiset fingerprints of documents, in DataFrame expressions only.

A fingerprint is a wide vector of sums, so it does not depend on the order of
paragraphs and can be updated: a paragraph is inserted or deleted by adding or
subtracting its own vector (``plus``, ``minus``).

* ``exact``: 8 lanes; each paragraph adds 60 bits per lane of its SHA-512, modulo
  2**60. Equal multisets of paragraphs have equal lanes.
* ``sketch``: 64 lanes of 32 bits, two to a long; each phrase of a paragraph adds
  the bits of its 64-bit hash, modulo 2**32. With the number of phrases these are
  +1/-1 projections, and the cosine of two fingerprints estimates the share of
  common phrases (``likeness``).

Paragraphs end at line feeds. Phrases end at line feeds and where white space follows
one of ``n s t`` or any ASCII punctuation, so an insertion changes the phrases around
it only.

Semantics: null text counts as empty (one empty paragraph); rows are
fingerprinted one by one, so repeated rows, ties and extra columns don't matter.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

LANES, BITS, SKETCH = 8, 60, 32
MOST_BOUNDS = 1 << 16
PHRASE_END = r"\n|(?<=[nst\p{Punct}])\s+"
_PAIR = (1 << 32) | 1
_LOW = (1 << 32) - 1


def fingerprint(text: Column) -> Column:
    """struct<exact: array<long>, sketch: array<long>, n: long> of a text."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    paragraphs = F.transform(F.split(text, "\n"), lambda p: F.sha2(p.cast("binary"), 512))
    phrases = F.transform(F.split(text, PHRASE_END), lambda p: F.xxhash64(p))

    def vectors(both: Column) -> Column:
        shas, hashes = both["shas"], both["hashes"]
        zero = F.lit(0).cast("long")

        def exact(j: int) -> Column:
            return F.aggregate(shas, zero, lambda a, h: (a + F.conv(F.substring(h, 16 * j + 1, BITS // 4), 16, 10).cast("long")) % F.lit(1 << BITS))

        def sketch(i: int) -> Column:
            return F.aggregate(hashes, zero, lambda a, h: a + F.shiftrightunsigned(h, i).bitwiseAND(F.lit(_PAIR)))

        lanes = [exact(j) for j in range(LANES)], [sketch(i) for i in range(SKETCH)]
        return F.struct(F.array(*lanes[0]).alias("exact"), F.array(*lanes[1]).alias("sketch"), F.size(hashes).cast("long").alias("n"))

    # hashed once: the array of one element is what binds the hashes for all lanes
    once = F.array(F.struct(paragraphs.alias("shas"), phrases.alias("hashes")))
    return F.element_at(F.transform(once, vectors), 1)


def plus(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of the multiset sum (sign 1) or difference (sign -1)."""
    exact = F.zip_with(a["exact"], b["exact"], lambda x, y: F.pmod(x + sign * y, F.lit(1 << BITS)))
    sketch = F.zip_with(a["sketch"], b["sketch"], lambda x, y: x + sign * y)
    return F.struct(exact.alias("exact"), sketch.alias("sketch"), (a["n"] + sign * b["n"]).alias("n"))


def minus(a: Column, b: Column) -> Column:
    return plus(a, b, -1)


def _signs(f: Column) -> Column:
    halves = F.concat(F.transform(f["sketch"], lambda x: x.bitwiseAND(F.lit(_LOW))), F.transform(f["sketch"], lambda x: F.shiftrightunsigned(x, 32)))
    return F.transform(halves, lambda c: (F.lit(2) * c - f["n"]).cast("double"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def likeness(a: Column, b: Column) -> Column:
    """0 to 1; 1 for equal fingerprints."""
    x, y = _signs(a), _signs(b)
    cosine = _dot(x, y) / F.sqrt(F.greatest(_dot(x, x) * _dot(y, y), F.lit(1.0)))
    same = (a["exact"] == b["exact"]) & (a["sketch"] == b["sketch"]) & (a["n"] == b["n"])
    return F.when(same, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine)))


def printed(f: Column) -> Column:
    """Hexadecimal form: the exact lanes, the sketch lanes, the number of phrases."""
    exact = F.array_join(F.transform(f["exact"], lambda x: F.lpad(F.hex(x), BITS // 4, "0")), "")
    sketch = F.array_join(F.transform(f["sketch"], lambda x: F.lpad(F.hex(x), 16, "0")), "")
    return F.concat_ws(":", exact, sketch, F.hex(f["n"]))


def with_next(docs: DataFrame, id_col: str, text_col: str, block_rows: int = 2000) -> DataFrame:
    """doc_id, text, print, and next_text, next_print: those of the next document by (id with null first, text); after the last comes the first.

    Documents are dealt into blocks of neighbouring ids. The blocks' bounds are
    approximate quantiles that are ids of the table, so the documents at a bound are
    known without a look at other rows: they are also sent to the block before, as
    its end. A row's block is found in two steps, among bounds of ranges of bounds
    first. Bounds go through the driver as numbers, so there are ``MOST_BOUNDS`` of
    them; a larger table has larger blocks, which are sorted with spilling, not held.
    """
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), key.alias("key"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    columns = ("text", "print")
    n = max(1, min(MOST_BOUNDS, -(-docs.count() // block_rows)))
    bounds, least = rows.agg(F.percentile_approx("key", [i / n for i in range(n)], 20 * n), F.min("key")).first()
    least = least or 0
    bounds = sorted({least, *(bounds or [])})
    width = math.isqrt(len(bounds)) + 1
    listed = lambda numbers: F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<long>")
    upto = lambda numbers: F.size(F.filter(numbers, lambda b: b <= F.col("key")))
    edges = listed(bounds)
    rows = rows.withColumn("range", (upto(listed(bounds[::width])) - 1) * width)
    rows = rows.withColumn("own", F.col("range") + upto(F.slice(edges, F.col("range") + 1, width)))
    own = F.col("own")
    before = F.when(F.col("key") == F.lit(least), F.lit(len(bounds))).when(F.element_at(edges, own) == F.col("key"), own - 1)
    dealt = rows.withColumn("place", F.explode(F.array_compact(F.array(F.struct(F.col("own").alias("block"), F.lit(False).alias("tail")), F.when(before.isNotNull(), F.struct(before.alias("block"), F.lit(True).alias("tail")))))))
    dealt = dealt.select("doc_id", "key", "text", F.col("place.block").alias("block"), F.col("place.tail").alias("tail")).repartition("block")
    # fingerprinted after the shuffle, which carries texts alone
    dealt = dealt.withColumn("print", fingerprint(F.col("text")))
    window = Window.partitionBy("block").orderBy("tail", "key", "text")
    for column in columns:
        dealt = dealt.withColumn(f"next_{column}", F.lead(column).over(window))
    return dealt.where(~F.col("tail")).select("doc_id", *columns, *[f"next_{c}" for c in columns])


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form and of the next text, and their likeness."""
    rows = with_next(docs, id_col, text_col)
    n = F.char_length("text")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - tail), F.substring(F.col("next_text"), F.lit(1), tail))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), F.col("print").alias("own"), F.col("next_print").alias("next"))
    rows = rows.select("*", fingerprint(F.col("edited")).alias("other"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        printed(F.col("own")).alias("fingerprint"),
        printed(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return compare_edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))
