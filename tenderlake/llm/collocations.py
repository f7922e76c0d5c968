"""Phrase collocations from depth-truncated suffix trees, built group by group of word prefixes.

Every word occurrence is the begin of a suffix: its language and up to ``words`` words
of its piece. All suffixes of a corpus make a tree whose nodes are the phrases, and
a phrase occurs as often as the leaves under its node say. No machine can hold that
tree, so it is partitioned vertically:

1. One scan finds the prefixes with more suffixes than ``budget``. A chunk of text
   reports a prefix only if it holds it often enough (its share of half a budget),
   so that what is not reported sums to less than half a budget and no such prefix
   is missed. Their hashes, at most 10 x words / budget, go to all tasks.
2. A suffix belongs to its shortest prefix that is not among these, and the prefixes
   are dealt into groups of about half a budget. Suffixes that are heavy to their
   last word are dealt by chunk.
3. A chunk counts its equal suffixes and sends each group one packed row: the words
   it needs, and the suffixes sorted, one column for each place.
4. A group sorts its suffixes, which is the order of leaves in its subtrees, and reads
   the count of every node as the total of its leaves. Nodes above a group's
   prefixes have leaves in several groups: such partial counts, the number of words
   of the language (the root) among them, are summed over groups.

The rest are joins of the table of frequent phrases with itself: parts of a phrase
are at least as frequent as the phrase.

Semantics. Texts are lower-cased (A-Z only), cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces
and those at spaces and tabs into words; a null text is empty, a null language is
``und``. Repeated rows count each, ids are not read, texts of any length are counted
whole. Arithmetic is exact. An empty table gives an empty result. Other columns are
ignored. Words of a chunk are told apart by 64-bit hashes.
"""

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.llm import groups as G
from tenderlake.llm import words as W
from tenderlake.llm.storage import checkpointed

#: exact for counts of 16 digits
SCORE = "cast(1000 * cast(a as decimal(16,0)) * cast(n as decimal(16,0)) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0))) as long)"

BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
SEPARATORS = BREAKS.copy()
SEPARATORS[[0x20, 0x09]] = True
CHUNK = 1 << 20  #: words counted together in a task
LANG_SEED = 0x1A46

_U = np.uint64


class Suffixes:
    """Word occurrences of a chunk: language, words as they follow in the piece, and hashes of all prefixes."""

    def __init__(self, depth: int):
        self.depth, self.parts, self.size = depth, [], 0

    def add(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray) -> None:
        """Texts, and the ordinal of each one's language."""
        w = W.words_of(data, offsets, True, SEPARATORS)
        n = len(w.starts)
        if not n:
            return
        breaks = np.cumsum(BREAKS[w.data[: len(data)]], dtype=np.int64)
        piece = np.concatenate([[0], breaks])[w.starts]
        joined = (piece[1:] == piece[:-1]) & (w.doc[1:] == w.doc[:-1])  # a word follows in its piece
        after = np.ones(n, np.uint8)  # words of the piece from here on, as far as the depth
        for _ in range(self.depth - 1):
            after[:-1] = np.where(joined, np.minimum(after[1:] + 1, self.depth), 1)
        self.parts.append((w, w.hashes(), langs[w.doc].astype(np.int32), after))
        self.size += n

    def close(self, langs: list[bytes]) -> "Suffixes":
        """Number the words of the chunk; 0 stands for no word."""
        self.langs = langs
        hashes = np.concatenate([h for _, h, _, _ in self.parts])
        self.lang, self.after = (np.concatenate([p[k] for p in self.parts]) for k in (2, 3))
        self.dictionary, at, ids = np.unique(hashes, return_index=True, return_inverse=True)
        self.at, self.ids = at, (ids + 1).astype(np.int32)
        self.begins = np.cumsum([0] + [len(h) for _, h, _, _ in self.parts])
        salt = np.array([W.mix(np.frombuffer(x[:8].ljust(8, b"\0"), np.uint64) + _U(LANG_SEED + len(x)))[0] for x in langs], _U)
        for k, x in enumerate(langs):
            for i in range(8, len(x), 8):
                salt[k] = W.mix(salt[k : k + 1] ^ np.frombuffer(x[i : i + 8].ljust(8, b"\0"), np.uint64))[0]
        self.hashes, self.root = hashes, salt
        self.texts, self.parts = self._texts(), []
        return self

    def _texts(self) -> pa.Array:
        """Texts of languages and then words, by number."""
        parts, size, order = [], [], []
        for (w, _, _, _), begin, end in zip(self.parts, self.begins[:-1], self.begins[1:]):
            own = np.flatnonzero((self.at >= begin) & (self.at < end))
            at = self.at[own] - begin
            n = w.ends[at] - w.starts[at]
            parts.append(w.data[G.spans(w.starts[at], n)].tobytes())
            size.append(n)
            order.append(own)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(size))]).astype(np.int64)
        found = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(b"".join(parts))])
        back = np.empty(len(found), np.int64)
        back[np.concatenate(order)] = np.arange(len(found))
        return pa.concat_arrays([pa.array(self.langs, pa.large_binary()), found.take(pa.array(back))])

    def column(self, k: int) -> np.ndarray:
        """Number of the k-th word of every suffix."""
        out = np.zeros(self.size, np.int32)
        out[: self.size - k] = self.ids[k:]
        out[self.after <= k] = 0
        return out

    def prefixes(self):
        """Hashes of the prefixes of 1, 2, ... words of every suffix; a suffix that ends has no more words."""
        h = self.root[self.lang]
        for k, c in enumerate(W.constants(self.depth, LANG_SEED)):
            word = np.zeros(self.size, _U)
            word[: self.size - k] = self.hashes[k:]
            word[self.after <= k] = 0
            h = W.mix(h * c + word)
            yield h


def chunks(batches, depth: int):
    """Chunks of about ``CHUNK`` words of the texts of a task."""
    open_, langs = Suffixes(depth), {}
    for batch in batches:
        table = pa.Table.from_batches([batch])
        of = np.array([langs.setdefault(x.encode(), len(langs)) for x in table["lang"].to_pylist()], np.int64)
        data, offsets = W.utf8(table["text"])
        for i, j in W.slices(offsets, 2 << 20):
            open_.add(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], of[i:j])
            if open_.size >= CHUNK:
                yield open_.close([*langs])
                open_, langs = Suffixes(depth), {}
                of = np.array([langs.setdefault(x.encode(), len(langs)) for x in table["lang"].to_pylist()], np.int64)
    if open_.size:
        yield open_.close([*langs])


def heavy_prefixes(texts: DataFrame, depth: int, budget: int, words: int) -> tuple[int, list[np.ndarray]]:
    """Number of words, and sorted hashes of the prefixes of each depth that may have more than ``budget`` suffixes.

    ``words`` is as many as there can be. Prefixes named have half a budget at least.
    """
    kinds = pa.schema([("depth", pa.int32()), ("hash", pa.int64()), ("n", pa.int64())])

    def count(batches):
        for chunk in chunks(batches, depth):
            least = max(1.0, chunk.size * budget / (2 * words))
            yield pa.RecordBatch.from_arrays([pa.array([-1]).cast(pa.int32()), pa.array([0]), pa.array([chunk.size])], schema=kinds)
            keep = np.ones(chunk.size, bool)
            for k, h in enumerate(chunk.prefixes()):
                # a count of slots leaves few to sort; prefixes of a rare one are rare
                slot = (h >> _U(44)).astype(np.int64)
                keep &= np.bincount(slot[keep], minlength=1 << 20)[slot] >= least
                found, n = np.unique(h[keep], return_counts=True)
                found, n = found[n >= least], n[n >= least]
                keep &= G.member(h, found)
                if not len(found):
                    break
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), k, np.int32)), pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], schema=kinds)

    found = texts.mapInArrow(count, "depth int, hash long, n long").groupBy("depth", "hash").agg(F.sum("n").alias("n")).where((F.col("n") >= budget / 2) | (F.col("depth") < 0)).collect()
    return sum(r["n"] for r in found if r["depth"] < 0), [np.sort(np.array([r["hash"] for r in found if r["depth"] == k], np.int64).view(_U)) for k in range(depth)]


def gathering(owner: np.ndarray, groups: int, columns: list[np.ndarray], words: int, whole: np.ndarray) -> np.ndarray:
    """A key that rises with the group and puts equal suffixes side by side, after the first words if these fit."""
    groups_bits, bits = groups.bit_length(), words.bit_length()
    rest = 64 - groups_bits - 2 * bits
    if rest < 8:
        return owner.astype(_U) << _U(64 - groups_bits) | whole >> _U(groups_bits)
    first = (owner.astype(np.int64) << 2 * bits | columns[1].astype(np.int64) << bits | columns[min(2, len(columns) - 1)]).astype(_U)
    return first << _U(rest) | whole >> _U(64 - rest)


def sort_keys(columns: list[np.ndarray], most: int) -> list[np.ndarray]:
    """The columns (numbers up to ``most``) side by side in as few 64-bit keys as hold them, first columns first."""
    bits = max(1, most.bit_length())
    per = max(1, 64 // bits)
    keys = []
    for i in range(0, len(columns), per):
        key = np.zeros(len(columns[0]), _U)
        for c in columns[i : i + per]:
            key = key << _U(bits) | c.astype(_U)
        keys.append(key)
    return keys


def pack(chunk: Suffixes, heavy: list[np.ndarray], groups: int, number: int):
    """A row for each group: its words, and its suffixes sorted and counted."""
    depth, squeeze = chunk.depth, zstandard.ZstdCompressor(level=1).compress
    level, owner, open_ = np.full(chunk.size, depth, np.uint8), np.full(chunk.size, number % groups, np.int64), np.ones(chunk.size, bool)
    for k, h in enumerate(chunk.prefixes()):  # the shortest prefix that is not heavy
        light = open_ & ~G.member(h, heavy[k])
        level[light], owner[light] = k, (h[light] % _U(groups)).astype(np.int64)
        open_ &= ~light
        if not open_.any():
            break
    columns = [chunk.lang, *[chunk.column(k) for k in range(depth)]]
    *_, whole = chunk.prefixes()
    order = np.argsort(gathering(owner, groups, columns, len(chunk.dictionary), whole))
    columns = [c[order] for c in columns]
    owner, level = owner[order], level[order]
    fresh = np.zeros(len(order), bool)
    fresh[0] = True
    for c in (owner, *columns):
        fresh[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(fresh)
    n = np.diff(np.append(at, len(order)))
    columns, owner, level = [c[at] for c in columns], owner[at], level[at]
    starts, sizes = G.runs(owner)
    place, texts = np.zeros(len(chunk.dictionary) + 1, np.int32), chunk.texts
    for s, size in zip(starts.tolist(), sizes.tolist()):
        own = [c[s : s + size] for c in columns]
        used = np.zeros(len(place), bool)
        for c in own[1:]:
            used[c] = True
        used[0] = False
        words = np.flatnonzero(used)
        place[words] = np.arange(1, len(words) + 1)
        place[0] = 0
        lang = np.unique(own[0])
        own_texts = texts.take(pa.array(np.concatenate([lang, words - 1 + len(chunk.langs)])))
        kind = np.uint16 if len(own_texts) < 1 << 16 else np.uint32
        body = [np.searchsorted(lang, own[0]).astype(kind), *[place[c].astype(kind) for c in own[1:]]]
        data = b"".join([level[s : s + size].tobytes(), n[s : s + size].astype(np.uint32).tobytes(), *[c.tobytes() for c in body]])
        _, ends, letters = own_texts.buffers()
        lengths = np.diff(np.frombuffer(ends, np.int64, len(own_texts) + 1)).astype(np.uint32)
        yield int(owner[s]), size, len(lang), squeeze(lengths.tobytes()), squeeze(letters.to_pybytes()), squeeze(data)


PACKED = f"{G.GROUP} long, size long, langs int, lengths binary, texts binary, data binary"


def unpacked(table: pa.Table, depth: int):
    """Suffixes of a group: texts of languages and words, and columns language, words, level, count."""
    plain, parts, texts, base = zstandard.ZstdDecompressor().decompress, [], [], 0
    for size, langs, lengths, text, data in zip(*[table[c].to_pylist() for c in ("size", "langs", "lengths", "texts", "data")]):
        lengths, data = np.frombuffer(plain(lengths), np.uint32), plain(data)
        kind = np.uint16 if len(lengths) < 1 << 16 else np.uint32
        body = np.frombuffer(data, kind, offset=5 * size).reshape(depth + 1, size).astype(np.int64)
        body[0] += base + 1
        body[1:] += np.where(body[1:] > 0, base + langs, 0)
        parts.append((body, np.frombuffer(data, np.uint8, size), np.frombuffer(data, np.uint32, size, size)))
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        texts.append(pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(plain(text))]))
        base += len(lengths)
    coded = pa.chunked_array(texts).combine_chunks().dictionary_encode()
    number = np.concatenate([[0], coded.indices.to_numpy() + 1])  # equal texts of chunks have one number
    columns = [number[np.concatenate([p[0][k] for p in parts])].astype(np.int32) for k in range(depth + 1)]
    return coded.dictionary, columns, np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]).astype(np.int64)


def nodes(table: pa.Table, depth: int, least: int) -> pa.Table:
    """Counts of the nodes of a group: those below its prefixes from ``least`` on, those above all of them, as partial counts."""
    texts, columns, level, n = unpacked(table, depth)
    keys = sort_keys(columns, len(texts))
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
    columns, level, n = [c[order] for c in columns], level[order], n[order]
    fresh = np.zeros(len(n), bool)
    fresh[0] = True
    langs, phrases, sizes, counts = [], [], [], []
    for k in range(depth + 1):  # nodes of k words; the root of a language has none
        fresh[1:] |= columns[k][1:] != columns[k][:-1]
        at = np.flatnonzero(fresh)
        total = np.add.reduceat(n, at)
        real = (columns[k][at] > 0) & ((total >= least) | (level[at] >= k))
        at, total = at[real], total[real]
        pick = lambda c: texts.take(pa.array(c[at] - 1)).to_pylist()
        langs += [x.decode() for x in pick(columns[0])]
        phrases += [b" ".join(x).decode() for x in zip(*[pick(c) for c in columns[1 : k + 1]])] if k else [""] * len(at)
        sizes += [k] * len(at)
        counts.append(total)
    return pa.table({"lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.string()), "size": pa.array(sizes, pa.int32()), "f": pa.array(np.concatenate(counts), pa.int64())})


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", words: int = 5, least: int = 100, budget: int = 2 << 20) -> DataFrame:
    """Columns lang, phrase, size (words), f: all phrases that occur ``least`` times; size 0 is the number of words of the language."""
    texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))
    most = texts.select(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    n, heavy = heavy_prefixes(texts, words, budget, max(1, most // 2))  # a word has a byte and one after it
    groups = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * n // budget))

    def send(batches):
        for number, chunk in enumerate(chunks(batches, words)):
            for row in pack(chunk, heavy, groups, int(chunk.hashes[0] % _U(1 << 40)) + number):
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], schema=sent)

    sent = pa.schema([(G.GROUP, pa.int64()), ("size", pa.int64()), ("langs", pa.int32()), ("lengths", pa.binary()), ("texts", pa.binary()), ("data", pa.binary())])

    def count(table: pa.Table) -> pa.Table:
        return nodes(table, words, least)

    found = texts.mapInArrow(send, PACKED).groupBy(G.GROUP).applyInArrow(count, "lang string, phrase string, size int, f long")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("size") == 0))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", words: int = 5, least: int = 100, within: int = 100, top: int = 2000, budget: int = 2 << 20) -> DataFrame:
    """Columns lang, rank, phrase, a, l, r, n, score: of each language the first ``top`` phrases of 2 to ``words`` words.

    a counts the phrase, l and r the two parts at the cut that gives the lowest score
    floor(1000 * a * n / (l * r)), n the words of the language. Phrases inside a longer one
    that occurs ``within`` per cent as often, or more, are left out.
    """
    known = checkpointed(phrase_counts(docs, text_col, lang_col, words, least, budget))
    part = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    several = known.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))

    inner = several.where("size > 2").withColumn("len", F.explode(F.sequence(F.lit(2), F.col("size") - 1))).withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("len") + 1)))
    longer = inner.groupBy("lang", part(F.col("at"), F.col("len")).alias("phrase")).agg(F.max("a").alias("longer"))
    alone = several.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < within * F.col("a"))).drop("longer")

    counts = known.where("size > 0")
    cuts = alone.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    totals = known.where("size = 0").select("lang", F.col("f").alias("n"))
    if totals.limit(MANY_LANGS).count() < MANY_LANGS:
        totals = F.broadcast(totals)
    scored = cuts.join(totals, "lang").withColumn("score", F.expr(SCORE))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = lowest.select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score").withColumn("rank", F.row_number().over(order).cast("long"))
    return out.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


MANY_LANGS = 10_000  #: fewer languages than this are sent to all tasks


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = """
WITH pieces AS (
  SELECT lang, row_number() OVER () AS p, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\n-\\r]')) AS piece
    FROM documents
  )
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces WHERE len(w) > 0
), grams AS (
  SELECT lang, w[i : i + m - 1] AS g, m FROM starts, range(1, 6) AS t(m) WHERE i + m - 1 <= len(w)
), f AS (
  SELECT lang, g, m, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), n AS (
  SELECT lang, count(*) AS n FROM starts GROUP BY lang
), longer AS (
  SELECT lang, g[i : i + m2 - 1] AS g, max(f) AS f
  FROM (SELECT lang, g, m, f, unnest(range(2, m)) AS m2 FROM f WHERE m > 2), range(1, 5) AS t(i) WHERE i + m2 - 1 <= m GROUP BY ALL
), kept AS (
  SELECT f.* FROM f LEFT JOIN longer USING (lang, g) WHERE f.m > 1 AND NOT coalesce(100 * longer.f >= 100 * f.f, false)
), cuts AS (
  SELECT kept.lang, kept.g, kept.f AS a, k, l.f AS l, r.f AS r, n.n, (1000::HUGEINT * kept.f * n.n) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept) kept
  JOIN n USING (lang)
  JOIN f AS l ON l.lang = kept.lang AND l.g = kept.g[1:k]
  JOIN f AS r ON r.lang = kept.lang AND r.g = kept.g[k + 1 :]
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM lowest
)
SELECT * FROM ranked WHERE rank <= 2000
"""
