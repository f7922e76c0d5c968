"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

1. Every whole text is reduced to some twenty statistics, kept in a small table.
2. Standardised statistics are mapped to random Fourier features, whose inner
   products approximate a Gaussian kernel. Each partition adds up its normal
   equations, by fold; the sums are added on the cluster.
3. Four ridge models, each without one fold, score that fold. Those scores, counted
   in ``BINS`` bins, give an isotonic curve (pool adjacent violators).
4. The model of all folds and the curve score every row.

Semantics: null text counts as empty and is scored like any text. Without any
labelled row every score is 0.5. Repeated label rows weigh repeatedly. Extra
columns are ignored; null ids match no label.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm import words as W
from tenderlake.llm.groups import runs
from tenderlake.llm.storage import Scratch, materialize

FOURIER, BINS, RIDGE, FOLDS = 256, 2048, 1.0, 4
LOW, HIGH = -0.5, 1.5

#: byte classes whose shares are statistics
CLASSES = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "aeiouAEIOU", "0123456789", ".,;:", "!?", "#$%&*@^~=+", "|<>[]{}()/\\_", "\"'`-", " ", "\n\r\t"]


def _tables() -> list[np.ndarray]:
    tables = [np.isin(np.arange(256), np.frombuffer(c.encode(), np.uint8)) for c in CLASSES]
    return [*tables, np.arange(256) >= 128]


def statistics(column: pa.Array) -> np.ndarray:
    """A row of statistics for each text."""
    data, offsets = W.utf8(column)
    tables, out = _tables(), []
    for a, b in W.slices(offsets):
        part, begin = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        w = W.words_of(part, begin)
        size = np.diff(begin)
        shares = []
        for t in tables:
            total = np.concatenate([[0], np.cumsum(t[part])])
            shares.append((total[begin[1:]] - total[begin[:-1]]) / np.maximum(size, 1))
        hashes, length = w.hashes(), w.ends - w.starts
        three, whole3 = W.windows(hashes, w.doc, 3, seed=9)
        feeds = np.concatenate([[0], np.cumsum(part == 10)])
        last = w.data[np.maximum(w.ends - 1, 0)]
        first = w.data[w.starts]
        upper = tables[0][first] & tables[0][w.data[np.minimum(w.starts + 1, len(w.data) - 1)]]
        ends_odd = ~(tables[0][last] | tables[1][last] | (last >= 128))
        symbol = tables[6][last] | tables[7][last]
        line = feeds[w.starts] + w.doc
        start, n = runs(line)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * W.constants(1, 4)[0] ** (np.arange(len(hashes)) - np.repeat(start, n)).astype(np.uint64))])
        lines, line_doc = W.mix(sums[start + n] - sums[start]), w.doc[start]
        line_at = np.searchsorted(line_doc, np.arange(b - a + 1))
        for k, (i, j) in enumerate(itertools.pairwise(w.first.tolist())):
            m = j - i
            if not m:
                out.append([s[k] for s in shares] + [np.log1p(size[k])] + [0.0] * 13)
                continue
            _, often = np.unique(hashes[i:j], return_counts=True)
            grams = three[i : max(i, j - 2)]
            own = lines[line_at[k] : line_at[k + 1]]
            p = often / m
            rows = [s[k] for s in shares] + [
                np.log1p(size[k]),
                np.log1p(m),
                length[i:j].mean(),
                length[i:j].std(),
                len(often) / m,
                often.max() / m,
                -(p * np.log(p)).sum(),
                (1 - len(np.unique(grams)) / len(grams)) if len(grams) else 0.0,
                1 - len(np.unique(own)) / len(own),
                np.log1p(m / len(own)),
                upper[i:j].mean(),
                ends_odd[i:j].mean(),
                symbol[i:j].mean(),
                (length[i:j] == 1).mean(),
            ]
            out.append(rows)
    return np.array(out, float).reshape(len(out), len(CLASSES) + 1 + 14)


def stats_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def run(batches):
        for batch in batches:
            x = statistics(batch.column("text"))
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), values], ["doc_id", "stats"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, stats array<double>")


def matrix(batch, column: str = "stats") -> np.ndarray:
    values = batch.column(column)
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1) if len(values) else np.zeros((0, len(CLASSES) + 15))


class Fourier:
    """Random Fourier features of standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, deviation: np.ndarray, width: float = 0.7):
        r = np.random.default_rng(11)
        self.mean, self.deviation = mean, deviation
        self.directions = r.normal(size=(len(mean), FOURIER)) / (width * np.sqrt(len(mean)))
        self.phases = r.uniform(0, 2 * np.pi, FOURIER)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / np.maximum(self.deviation, 1e-6), -6, 6)
        z = np.sqrt(2 / FOURIER) * np.cos(x @ self.directions + self.phases)
        return np.hstack([z, np.ones((len(x), 1))])


def isotonic(x: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins in order: positions and rising means."""
    blocks: list[list[float]] = []
    for p, w, s in zip(x, weight, total):
        blocks.append([p * w, w, s])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([(b[2] + 0.5) / (b[1] + 1) for b in blocks])


def fit(stats: DataFrame, labels: DataFrame):
    """labels: doc_id, label (0 or 1), fold (0 to FOLDS - 1). Fourier map, weights and isotonic curve; None without labels."""
    with Scratch(stats.sparkSession, "labelled") as scratch:
        return _fit(scratch.table(stats.join(labels, "doc_id").select("fold", "label", "stats"), "labelled"))


def _fit(labelled: DataFrame):
    positions = labelled.select(F.posexplode("stats").alias("k", "v"))
    moments = positions.groupBy("k").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("dev")).orderBy("k").collect()  # a row for each statistic
    if not moments:
        return None
    features = Fourier(np.array([m.mean for m in moments]), np.array([m.dev for m in moments]))
    wide = FOURIER + 1

    def equations(batches):
        sums = np.zeros((FOLDS, wide, wide + 1))
        for batch in batches:
            x, y, fold = features(matrix(batch)), batch.column("label").to_numpy().astype(float), batch.column("fold").to_numpy()
            for f in range(FOLDS):
                own = x[fold == f]
                sums[f] += np.hstack([own.T @ own, (own.T @ y[fold == f])[:, None]])
        index = [(f, i) for f in range(FOLDS) for i in range(wide)]
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in index], pa.int32()), pa.array([i for _, i in index], pa.int32()), pa.array([sums[f, i].tobytes() for f, i in index], pa.binary())], ["fold", "row", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(s) for s in table["sums"].to_pylist()], axis=0)
        return pa.table({"fold": table["fold"][:1], "row": table["row"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

    added = labelled.mapInArrow(equations, "fold int, row int, sums binary").groupBy("fold", "row").applyInArrow(add, "fold int, row int, sums binary").collect()
    sums = np.zeros((FOLDS, wide, wide + 1))
    for r in added:  # FOLDS * wide rows
        sums[r.fold, r.row] = np.frombuffer(r.sums)

    def solve(s: np.ndarray) -> np.ndarray:
        return np.linalg.solve(s[:, :-1] + RIDGE * np.diag([1.0] * FOURIER + [1e-3]), s[:, -1])

    weights = solve(sums.sum(axis=0))
    without = np.stack([solve(sums.sum(axis=0) - sums[f]) for f in range(FOLDS)], axis=1)

    def unseen(batches):
        for batch in batches:
            s = features(matrix(batch)) @ without
            s = s[np.arange(len(s)), batch.column("fold").to_numpy()]
            bins = np.clip((s - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("label")], ["bin", "label"])

    counted = labelled.mapInArrow(unseen, "bin int, label int").groupBy("bin").agg(F.count("*").alias("n"), F.sum("label").alias("good")).orderBy("bin").collect()  # BINS rows at most
    at = np.array([LOW + (r.bin + 0.5) / BINS * (HIGH - LOW) for r in counted])
    curve = isotonic(at, np.array([r.n for r in counted], float), np.array([r.good for r in counted], float))
    return features, weights, curve


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """Columns: doc_id, score, predicted. labels: doc_id, label, fold."""
    stats = materialize(stats_table(docs, id_col, text_col), "stats")
    model = fit(stats, labels)

    def predict(batches):
        for batch in batches:
            p = probability(model, matrix(batch))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.clip(p, 0, 1)), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return stats.mapInArrow(predict, "doc_id long, score double, predicted int")


def probability(model, x: np.ndarray) -> np.ndarray:
    if model is None:
        return np.full(len(x), 0.5)
    features, weights, curve = model
    return np.interp(features(x) @ weights, *curve)


def sampled(labels: DataFrame, rows: int) -> DataFrame:
    """Labels of about ``rows`` ids at most, chosen by a hash of the id; all of them if there are no more."""
    n = labels.select("doc_id").distinct().count()
    share = min(1.0, rows / max(n, 1))
    return labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, sample_rows: int = 200_000) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold. No row is shuffled.

    The model is fitted on labels of ``sample_rows`` ids at most, so their ids can be
    broadcast, and only the texts of labelled rows are reduced twice.
    """
    labels = sampled(labels, sample_rows)
    known = F.broadcast(labels.select(F.col("doc_id").alias("__labelled")).distinct())
    labelled = docs.join(known, F.col(f"`{id_col}`").cast("long") == F.col("__labelled"), "left_semi")
    with Scratch(docs.sparkSession, "quality") as scratch:
        model = fit(scratch.table(stats_table(labelled, id_col, text_col), "stats"), labels)

    def choose(batches):
        for batch in batches:
            good = probability(model, statistics(batch.column(text_col))) >= threshold
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)


def crc(column) -> F.col:
    return F.coalesce(F.crc32(column.cast("string").cast("binary")), F.lit(0))


def training_labels(labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """Labels of rows whose crc32(doc_id) mod 5 is not 0, with that remainder as fold."""
    fold = crc(F.col("doc_id")) % 5
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull() & (fold != 0))
    return known.select("doc_id", F.col(label_col).cast("int").alias("label"), (fold - 1).cast("int").alias("fold"))


def query(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    out = score(docs, training_labels(labels))
    return out.select("doc_id", (crc(F.col("doc_id")) % 5 == 0).alias("held_out"), "score", "predicted")
