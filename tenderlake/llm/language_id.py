"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

1. Document frequencies of hashed 1- to 3-grams over all labelled training rows
   (one vector of ``DIMENSIONS`` sums).
2. Follow-the-regularised-leader (proximal, elastic net) on a bounded sample of
   training rows: about ``sample_rows``, taken by a hash of the id. Shards learn in
   parallel from common weights, which are averaged after each pass.
3. A temperature is fitted on sampled rows that the weights did not see.
4. Every row's whole text is scored.

Semantics: texts are lower-cased, everything but letters counts as space. A null
text or one without letters is ``und`` with score 0, as is every text if no
training row has a language. Null ids are hashed as the empty text. Repeated rows
weigh repeatedly in training and are all scored. Extra columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.storage import Scratch
from tenderlake.llm.token_counts import portions
from tenderlake.llm.words import mix

DIMENSIONS = 1 << 14
STRETCH = 1 << 18  #: characters of a long text that are counted at once
UNKNOWN = "und"


def held_out(id_col: Column, modulus: int, remainder: int) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")), F.lit(0)) % modulus == remainder


_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def codes_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points, and which of them are letters."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return c, letters()[c]


def grams_of(c: np.ndarray) -> list[np.ndarray]:
    """Features of the 1-, 2- and 3-grams that begin at each place."""
    one, two, three = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    grams = [mix(c * one + np.uint64(1)), mix(c[:-1] * one + c[1:] * two), mix(c[:-2] * one + c[1:-1] * two + c[2:] * three)]
    return [(g % np.uint64(DIMENSIONS)).astype(np.int64) for g in grams]


def long_counts(text: str) -> tuple[np.ndarray, bool]:
    """Count of each feature and whether there is a letter, a stretch of the text at a time."""
    text = "  " + text.lower() + " "
    total, some, before = np.zeros(DIMENSIONS, np.int64), False, np.zeros(0, np.uint64)
    for at in range(0, len(text), STRETCH):
        c, is_letter = codes_of(text[at : at + STRETCH])
        some |= bool(is_letter.any())
        c = np.concatenate([before, np.where(is_letter, c, 32).astype(np.uint64)])
        c = c[np.concatenate([[True], (c[1:] != 32) | (c[:-1] != 32)])]
        for n, g in enumerate(grams_of(c)):
            total += np.bincount(g[max(len(before) - n, 0) :], minlength=DIMENSIONS)  # those before end in the last stretch
        before = c[-2:]
    return total, some


def ngram_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each non-zero: text, feature and count; and for each text whether it has a letter."""
    long = {i: long_counts(t) for i, t in enumerate(texts) if len(t) > STRETCH}
    codes = [codes_of("  " + ("" if i in long else t.lower()) + " ") for i, t in enumerate(texts)]
    doc = np.repeat(np.arange(len(texts)), [len(c) for c, _ in codes])
    c, is_letter = (np.concatenate(x) for x in zip(*codes))
    some = np.bincount(doc[is_letter], minlength=len(texts)) > 0
    c = np.where(is_letter, c, 32).astype(np.uint64)
    # one space for a run of them
    keep = np.concatenate([[True], (c[1:] != 32) | (c[:-1] != 32) | (doc[1:] != doc[:-1])])
    c, doc = c[keep], doc[keep]
    whole = [np.ones(len(c), bool), doc[1:] == doc[:-1], doc[2:] == doc[:-2]]
    key = np.concatenate([(doc[: len(g)] * DIMENSIONS + g)[w] for g, w in zip(grams_of(c), whole)])
    counts = np.bincount(key, minlength=len(texts) * DIMENSIONS)
    for i, (own, letter) in long.items():
        counts[i * DIMENSIONS : (i + 1) * DIMENSIONS], some[i] = own, letter
    at = np.flatnonzero(counts)
    return at // DIMENSIONS, at % DIMENSIONS, counts[at], some


def weighted(doc, feature, count, idf: np.ndarray, texts: int) -> np.ndarray:
    """TF-IDF with logarithmic counts, of length 1 per text."""
    value = (1 + np.log(count)) * idf[feature]
    norm = np.sqrt(np.bincount(doc, value * value, minlength=texts))
    return value / np.maximum(norm, 1e-12)[doc]


def few(part: list[str], most: int = 64):
    for i in range(0, len(part), most):
        yield part[i : i + most]


class FTRL:
    """Proximal follow-the-regularised-leader; weights are a closed form of its sums z and n."""

    def __init__(self, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((DIMENSIONS, classes)), np.zeros((DIMENSIONS, classes))

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, features: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(features)
        p = values @ w
        p = np.exp(p - p.max())
        p /= p.sum()
        p[label] -= 1
        g = values[:, None] * p
        n = self.n[features]
        self.z[features] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[features] = n + g * g


def log_probabilities(logits: np.ndarray, temperature: float) -> np.ndarray:
    x = logits / temperature
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of the least negative log-likelihood, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        return -log_probabilities(logits, np.exp(t))[np.arange(len(labels)), labels].mean()

    low, high, ratio = np.log(0.01), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(rows: DataFrame) -> np.ndarray:
    """How many rows have each feature; the sums are made on the cluster."""

    def count(batches):
        total = np.zeros(DIMENSIONS, np.int64)
        for batch in batches:
            for part in portions(batch, "text"):
                for texts in few(part):
                    total += np.bincount(ngram_counts(texts)[1], minlength=DIMENSIONS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.int64())], ["feature", "n"])

    found = rows.select("text").mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(DIMENSIONS)
    for r in found:  # DIMENSIONS rows at most
        out[r.feature] = r.n
    return out


def train(rows: DataFrame, sample_rows: int = 8000, shards: int = 8, passes: int = 6) -> tuple[list[str], np.ndarray, np.ndarray, float]:
    """rows: doc_id, text, lang (not null). Languages, IDF, weights and temperature."""
    counts = rows.groupBy("lang").count().collect()  # a row for each language
    languages = sorted(r["lang"] for r in counts)
    total = sum(r["count"] for r in counts)
    if not languages:
        return [], np.zeros(DIMENSIONS), np.zeros((DIMENSIONS, 0)), 1.0
    idf = np.log((1 + total) / (1 + document_frequencies(rows))) + 1
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000))
    sample = rows.where(place < int(1_000_000 * min(1.0, sample_rows / total)) + 1)

    def vectors(batches):
        for batch in batches:
            labels, shard = batch.column("label").to_pylist(), batch.column("shard").to_pylist()
            out, i = [], 0
            for part in portions(batch, "text"):
                for texts in few(part):
                    doc, feature, count, some = ngram_counts(texts)
                    value = weighted(doc, feature, count, idf, len(texts))
                    ends = np.searchsorted(doc, np.arange(len(texts) + 1))
                    for k, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
                        if some[k]:
                            out.append((shard[i + k], labels[i + k], feature[a:b].astype("<i4").tobytes(), value[a:b].astype("<f4").tobytes()))
                    i += len(texts)
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
            columns = [*zip(*out)] or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], ["shard", "label", "features", "vals"])

    label = F.array_position(F.array(*[F.lit(x) for x in languages]), F.col("lang")).cast("int") - 1
    shard = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards + 2)).cast("int")  # the last two calibrate
    with Scratch(rows.sparkSession, "ngrams") as scratch:
        return languages, idf, *_train(scratch.table(sample.select(shard.alias("shard"), label.alias("label"), "text").mapInArrow(vectors, "shard int, label int, features binary, vals binary"), "ngrams"), len(languages), shards, passes)


def _train(examples: DataFrame, classes: int, shards: int, passes: int) -> tuple[np.ndarray, float]:
    """Weights and temperature from sparse vectors."""
    model = FTRL(classes)

    def learn(z: np.ndarray, n: np.ndarray):
        def run(table: pa.Table) -> pa.Table:
            own = FTRL(classes)
            own.z, own.n = z.copy(), n.copy()
            rows = sorted(zip(table["label"].to_pylist(), table["features"].to_pylist(), table["vals"].to_pylist()), key=lambda r: r[1:])
            for i in np.random.default_rng(7).permutation(len(rows)):
                own.learn(np.frombuffer(rows[i][1], "<i4"), np.frombuffer(rows[i][2], "<f4").astype(float), rows[i][0])
            return pa.table({"z": pa.array([own.z.tobytes()], pa.binary()), "n": pa.array([own.n.tobytes()], pa.binary())})

        return run

    for _ in range(passes):
        states = examples.where(F.col("shard") < shards).groupBy("shard").applyInArrow(learn(model.z, model.n), "z binary, n binary").collect()  # ``shards`` rows
        if states:
            model.z, model.n = (np.mean([np.frombuffer(s[k]).reshape(model.z.shape) for s in states], axis=0) for k in "zn")
    weights = model.weights()
    held = examples.where(F.col("shard") >= shards).collect()  # a fifth of the bounded sample
    logits = [np.frombuffer(r.vals, "<f4") @ weights[np.frombuffer(r.features, "<i4")] for r in held]
    temperature = best_temperature(np.array(logits), np.array([r.label for r in held])) if held else 1.0
    return weights.astype(np.float32), temperature


def identify(docs: DataFrame, learn_from: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns: doc_id, lang_pred, score. learn_from: doc_id, text, lang."""
    languages, idf, weights, temperature = train(learn_from)

    def predict(batches):
        for batch in batches:
            names, scores = [], []
            for part in portions(batch, "text"):
                for texts in few(part):
                    doc, feature, count, some = ngram_counts(texts)
                    if not languages:
                        some[:] = False
                    value = weighted(doc, feature, count, idf, len(texts))
                    logits = np.stack([np.bincount(doc, value * weights[feature, k], minlength=len(texts)) for k in range(len(languages))], axis=1) if languages else np.zeros((len(texts), 1))
                    p = np.exp(log_probabilities(logits, temperature))
                    names += [languages[k] if s else UNKNOWN for k, s in zip(p.argmax(axis=1), some)]
                    scores += [float(x) if s else 0.0 for x, s in zip(p.max(axis=1), some)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(predict, "doc_id long, lang_pred string, score double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = docs.where(~held_out(F.col("doc_id"), 4, 2) & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    return identify(docs, known).select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
