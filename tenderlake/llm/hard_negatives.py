"""Hard negatives of anchor vectors by exact inner products, several candidates to one multiplication.

Components become whole numbers, floor(scale * x). A block of candidates is packed
(``Fields``): the components of ``Fields.per`` candidates in one dimension, made
non-negative by a bias, lie side by side in one 64-bit number. An anchor's
component times that number, summed over the dimensions, has every candidate's
inner product in its own field. A field holds any inner product that the largest
norm of the table allows (Cauchy-Schwarz), and sums are taken modulo 2^64, so
what carries between fields on the way is gone in the end and the unpacked
scores are exact.

Plan. Equal rows are counted before anything is dealt; of each as many copies go on
as a list of positives or negatives can hold. All rows are queried by the anchors,
in tiles: candidates are dealt by a hash of the row into blocks, anchors into
portions, and one task scores one block against one portion. Each tile returns the
first few of an anchor, and windows with a limit that starts before the shuffle
keep the first of all tiles. That runs twice: for the positives, and then for the
negatives within the score range of each positive. Neither depends on how many rows
share a label, an id or a vector, and no list of an anchor's candidates is built.

Semantics. A row takes part if id and label are not null and the vector is neither
null nor has a null or non-finite component; also left out are rows so long that
a hundred times a score would not fit a 64-bit integer (squared norm of 2^56 and more). Vectors of different lengths are
compared as if zeros followed, so an empty vector scores 0. Higher scores come
first, ties by smaller id. An anchor's positives are rows of its label with another
id; rows that repeat an id are rows of their own, anchors equal in id, label and
vector count once. Without anchors or rows the result is empty. Other columns are ignored.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenderlake.llm import groups as G
from tenderlake.llm.storage import checkpointed

NONE = np.iinfo(np.int64).min  #: score of a candidate that is not asked for
TILE, ANCHOR, PLACE = "__tile", "__anchor", "__place"
LONGEST = float(1 << 56)


class Fields:
    """Candidates' components in fields of 64-bit numbers, for scores of at most ``norm`` (a squared norm) either way."""

    def __init__(self, vectors: np.ndarray, norm: int, bias: int):
        self.width = max(int(norm), 1).bit_length() + 1  # -norm..norm
        self.per, self.n, self.bias = max(1, 64 // self.width), len(vectors), bias
        dims, words = vectors.shape[1], -(-self.n // self.per)
        biased = np.zeros((words * self.per, dims), np.uint64)
        biased[: self.n] = (vectors + bias).astype(np.uint64)
        self.packed = np.zeros((dims, words), np.uint64)
        for k, shift in enumerate(self.shifts):
            self.packed |= biased[k :: self.per].T << shift

    @property
    def shifts(self) -> np.ndarray:
        return np.arange(self.per, dtype=np.uint64) * np.uint64(self.width)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """Inner products of anchors (rows) with all candidates (columns)."""
        half = np.uint64(1 << (self.width - 1))
        # one multiplication for each anchor component and ``per`` candidates; all modulo 2^64
        sums = np.zeros((len(anchors), self.packed.shape[1]), np.uint64)
        for component, packed in zip(anchors.astype(np.uint64).T, self.packed):
            sums += component[:, None] * packed
        # what the bias added leaves every field, and half a field makes it non-negative
        back = half - (anchors.sum(axis=1) * self.bias).astype(np.uint64)
        sums += (back * np.bitwise_or.reduce(np.uint64(1) << self.shifts))[:, None]
        mask = np.uint64((1 << self.width) - 1)
        fields = np.stack([(sums >> shift) & mask for shift in self.shifts], axis=2).reshape(len(anchors), -1)[:, : self.n]
        return (fields - half).astype(np.int64)


def first(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of each row's k highest scores that are asked for, ties to earlier columns."""
    edge = np.partition(scores, -k, axis=1)[:, -k, None] if scores.shape[1] > k else NONE
    row, col = np.nonzero((scores >= edge) & (scores > NONE))
    order = np.lexsort((col, -scores[row, col], row))
    row, col = row[order], col[order]
    at, n = G.runs(row)
    keep = np.arange(len(row)) - np.repeat(at, n) < k
    return row[keep], col[keep]


def vectors(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of equal length, zeros after shorter vectors."""
    flat = column.combine_chunks()
    n = flat.value_lengths().to_numpy()
    out = np.zeros((len(n), dims), np.int64)
    out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = flat.flatten().to_numpy()
    return out


def valid_rows(rows: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """Columns id, label, vector (whole numbers) and norm (squared) of the rows that take part."""
    numbers = F.transform(F.col(f"`{vector_col}`"), lambda x: F.floor(x.cast("double") * scale).cast("int"))
    real = F.forall(F.col(f"`{vector_col}`"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < (1 << 30)))
    out = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("long").alias("label"), F.when(real, numbers).alias("vector")).where("id is not null and label is not null and vector is not null")
    out = out.withColumn("norm", F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return out.where(F.col("norm") < LONGEST)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    block: int = 32_768,
    portion: int = 4_096,
) -> DataFrame:
    """Columns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` tells anchors by the columns ``id`` and ``label``. Of each anchor's first
    ``positives`` rows of its label, the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score.
    """
    spark, keys, copies = rows.sparkSession, ["id", "label", "vector"], max(positives, negatives)
    table = valid_rows(rows, id_col, vector_col, label_col, scale)
    told = table.agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("anchors"), F.max(F.size("vector")).alias("dims"), F.max("norm").alias("norm"), F.min(F.array_min("vector")).alias("least")).first()
    dims, norm, bias = told["dims"] or 0, int(told["norm"] or 0), max(0, -int(told["least"] or 0))
    block, portion = (max(1, min(n, (1 << 25) // max(1, dims))) for n in (block, portion))
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-told["n"] // block))
    portions = max(1, -(-told["anchors"] // portion))
    counted = table.groupBy(*keys).agg(F.least(F.count("*"), F.lit(copies)).cast("int").alias("n"))
    dealt = counted.select(*keys, F.explode(F.sequence(F.lit(1), "n")).alias("copy")).withColumn("block", F.pmod(F.xxhash64(*keys, "copy"), F.lit(blocks)))
    candidates = dealt.withColumn("portion", F.explode(F.sequence(F.lit(0), F.lit(portions - 1)))).select((F.col("portion") * blocks + F.col("block")).alias(TILE), *keys)
    # under other names: both sides of a tile come from one table
    anchors = counted.where(is_anchor).select(F.xxhash64(*keys).alias(ANCHOR), *[F.col(k).alias(f"_{k}") for k in keys]).toDF(ANCHOR, *keys)

    def tiled(df: DataFrame) -> DataFrame:
        """Anchors, once for every block."""
        return df.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn(TILE, F.pmod(ANCHOR, F.lit(portions)) * blocks + F.col("block")).drop("block")

    def scored(anchors: pa.Table, candidates: pa.Table):
        """Some anchors at a time, with their scores against the candidates, which are in the order of ids."""
        if not len(anchors) or not len(candidates):
            return
        candidates = candidates.take(pc.sort_indices(candidates, [("id", "ascending")]))
        packed = Fields(vectors(candidates["vector"], dims), norm, bias)
        label, step = candidates["label"].to_numpy(), max(1, (1 << 19) // len(candidates))
        own = vectors(anchors["vector"], dims)
        for i in range(0, len(own), step):
            part = anchors.slice(i, step)
            yield part, packed.scores(own[i : i + step]), part["label"].to_numpy()[:, None] == label, candidates["id"].to_numpy()

    def found(parts: list[tuple], place: list[int], names: tuple[str, str]) -> pa.Table:
        """A row for each anchor and candidate found."""
        kinds = {ANCHOR: pa.int64(), "anchor_id": pa.int64(), PLACE: pa.int32(), names[0]: pa.int64(), names[1]: pa.int64()}
        rows = [(part[ANCHOR].to_numpy()[r], part["id"].to_numpy()[r], np.full(len(r), k, np.int32), ids[c], scores[r, c]) for (part, ids, scores, r, c), k in zip(parts, place)]
        return pa.table({n: pa.array(np.concatenate([x[i] for x in rows]) if rows else [], kind) for i, (n, kind) in enumerate(kinds.items())})

    def find_positives(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out = []
        for part, scores, same, ids in scored(anchors, candidates):
            other = part["id"].to_numpy()[:, None] != ids
            out.append((part, ids, scores, *first(np.where(same & other, scores, NONE), positives)))
        return found(out, [0] * len(out), ("positive_id", "positive_score"))

    def find_negatives(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out, place = [], []
        for part, scores, same, ids in scored(anchors, candidates):
            to, many = vectors(part["to"], positives), part["to"].combine_chunks().value_lengths().to_numpy()
            for k in range(positives):
                least, most = -(-low * to[:, k, None] // 100), high * to[:, k, None] // 100
                asked = ~same & (scores >= least) & (scores <= most) & (many > k)[:, None]
                out.append((part, ids, scores, *first(np.where(asked, scores, NONE), negatives)))
                place.append(k)
        return found(out, place, ("negative_id", "negative_score"))

    def best(rows: DataFrame, by: list[str], names: tuple[str, str], k: int) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(names[1]), names[0]))).where(F.col("rank") <= k)

    anchor = [ANCHOR, "anchor_id"]
    schema = f"{ANCHOR} long, anchor_id long, {PLACE} int, %s long, %s long"
    names = "positive_id", "positive_score"
    met = tiled(anchors).groupBy(TILE).cogroup(candidates.groupBy(TILE)).applyInArrow(find_positives, schema % names)
    near = best(met, anchor, names, positives).groupBy(*anchor).agg(F.array_sort(F.collect_list(F.struct("rank", *names))).alias("p"))  # ``positives`` at most
    near = near.select(ANCHOR, F.col("anchor_id").alias("id"), F.col("p.positive_id").alias("of"), F.col("p.positive_score").alias("to"))
    told = checkpointed(anchors.join(near, [ANCHOR, "id"]))  # else the positives would be looked for twice
    names = "negative_id", "negative_score"
    met = tiled(told.drop("of")).groupBy(TILE).cogroup(candidates.groupBy(TILE)).applyInArrow(find_negatives, schema % names)
    ranked = best(met, [*anchor, PLACE], names, negatives)
    listed = told.select(ANCHOR, F.col("id").alias("anchor_id"), F.posexplode(F.arrays_zip("of", "to")).alias(PLACE, "p"))
    return ranked.join(listed, [*anchor, PLACE]).select("anchor_id", F.col("p.of").alias("positive_id"), "rank", "negative_id", F.col("p.to").alias("positive_score"), "negative_score")


def query(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, F.col("id") % 50 == 0)


SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
  FROM r a JOIN r c ON a.vec_id <> c.vec_id OR a.label <> c.label WHERE a.vec_id % 50 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
