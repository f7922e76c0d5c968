"""Trained operators, search and fingerprints."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tenderlake.llm import fingerprints, language_id, quality, search


def test_languages_of_held_out_rows(spark, sf_dir):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = language_id.query(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([docs[r.doc_id].lang == r.lang_pred for r in held]) > 0.95


DOCS = "doc_id long, text string, lang string, score string"


def test_odd_texts_have_no_language(spark):
    rows = [(i, w * 30, lang, "") for i, (w, lang) in enumerate([("the house of ", "en"), ("das haus ist ", "de")] * 20)]
    odd = [(None, None, "en", ""), (1, "", None, ""), (2, "12 34 !?", "en", ""), (3, "the house " * 5000, None, ""), (3, "the house " * 5000, None, "")]
    docs, known = spark.createDataFrame(rows + odd, DOCS), spark.createDataFrame(rows, DOCS)
    got = language_id.identify(docs, known).collect()[len(rows) :]
    assert [(r.lang_pred, r.score) for r in got[:3]] == [("und", 0.0)] * 3 and [r.lang_pred for r in got[3:]] == ["en", "en"]
    assert {r.lang_pred for r in language_id.identify(docs, known.limit(0)).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), known.limit(0)).count() == 0


def test_long_texts_are_counted_in_stretches(monkeypatch):
    r = random.Random(5)
    texts = ["".join(r.choice("abΣİ ё\n1 ") for _ in range(n)) for n in (0, 1, 6, 7, 8, 50, 500)] + ["    " * 9, "a" * 30, "1" * 30]
    whole = language_id.ngram_counts(texts)
    for stretch in (1, 2, 3, 7):
        monkeypatch.setattr(language_id, "STRETCH", stretch)
        assert all((a == b).all() for a, b in zip(language_id.ngram_counts(texts), whole))


def test_temperature_fits_calibration():
    r = np.random.default_rng(1)
    logits = r.normal(size=(4000, 3))
    p = np.exp(language_id.log_probabilities(logits, 1.0))
    labels = np.array([r.choice(3, p=x) for x in p])
    assert abs(language_id.best_temperature(logits * 5, labels) - 5) < 0.7


def test_quality_of_held_out_rows(spark, sf_dir):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = quality.query(spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in held]) > 0.8


def test_quality_without_labels_and_with_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "a b\n" * 9000, "x")], "doc_id long, text string, stats string")
    none = spark.createDataFrame([], "doc_id long, label int, fold int")
    assert [r.score for r in quality.score(docs, none).collect()] == [0.5] * 4
    assert quality.score(docs.limit(0), none).count() == 0
    some = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 0, 2)], "doc_id long, label int, fold int")
    assert quality.score(docs, some).count() == 4
    assert quality.accepted(docs, none).columns == docs.columns and quality.accepted(docs, none).count() == 4


def test_isotonic_curve():
    x, y = quality.isotonic(np.arange(6.0), np.full(6, 1000.0), np.array([100, 50, 200, 300, 250, 900.0]))
    assert all(a <= b for a, b in zip(y, y[1:])) and len(x) == 4


def brute_search(docs, queries, k):
    term = re.compile(r"[a-z0-9\x80-\U0010ffff]+")
    lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s or "")
    bags = [(d, term.findall(lower(t))) for d, t in docs]
    n, mean = len(bags), sum(len(b) for _, b in bags) / len(bags)
    out = []
    for q, text in queries:
        words = set(term.findall(lower(text)))
        df = {w: sum(w in b for _, b in bags) for w in words}
        scores = []
        for d, b in bags:
            s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * b.count(w) * 2.2 / (b.count(w) + 1.2 * (0.25 + 0.75 * len(b) / mean)) for w in words if w in b)
            if s > 0:
                scores.append((-round(s, 9), d, s))
        out += [(q, i + 1, d, round(s, 6)) for i, (_, d, s) in enumerate(sorted(scores)[:k])]
    return out


def test_scores_are_not_rounded(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    (row,) = search.top_k(docs, spark.createDataFrame([(7, "a")], "item_id long, text string")).collect()
    assert row.score == pytest.approx(math.log(2) * 2.2 / (1 + 1.2 * (0.25 + 0.75 * 2 / 1.5)), rel=1e-13)


@pytest.mark.parametrize("k", [3, 50])
def test_search(spark, k):
    r = random.Random(2)
    vocabulary = [f"t{i}" for i in range(60)] + ["é", "Дом"]
    docs = [(i, " ".join(r.choice(vocabulary[: r.randint(5, 62)]) for _ in range(r.randint(0, 80)))) for i in range(300)]
    docs += [(400, None), (401, ""), (402, "T1, t1; É")]
    queries = [(1, "t1 T2 t50"), (2, "Дом é"), (3, None), (4, "?!"), (5, "nowhere"), (6, " ".join(vocabulary))]
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, score string").repartition(4)
    asked = spark.createDataFrame(queries, "item_id long, text string")
    got = search.top_k(frame, asked, k=k, shard_bytes=2000, block_docs=8).collect()
    assert sorted((x.query_id, x.rank, x.doc_id, round(x.score, 6)) for x in got) == sorted(brute_search(docs, queries, k))
    assert search.top_k(frame.limit(0), asked).count() == 0 and search.top_k(frame, asked.limit(0)).count() == 0


def plain_fingerprint(text):
    lanes, signs = [0] * 8, [0] * 64
    for p in text.split("\n"):
        h = hashlib.sha512(p.encode()).hexdigest()
        lanes = [(a + int(h[16 * j : 16 * j + 15], 16)) % 2**60 for j, a in enumerate(lanes)]
    phrases = re.split(r"\n|(?<=[nst!-/:-@\[-`{-~])\s+", text, flags=re.ASCII)
    for p in phrases:
        h = xxhash.xxh64(p.encode(), seed=42).intdigest()
        signs = [s + ((h >> (i % 32 + 32 * (i // 32))) & 1) for i, s in enumerate(signs)]
    pairs = [signs[i] | signs[32 + i] << 32 for i in range(32)]
    return "".join(f"{x:015X}" for x in lanes) + ":" + "".join(f"{x:016X}" for x in pairs) + f":{len(phrases):X}"


def test_fingerprints(spark):
    r = random.Random(3)
    values = [" ".join(r.choice(["an", "is", "the", "x.", "tön", "🎉"]) for _ in range(r.randint(0, 50))) for _ in range(60)]
    docs = [(i * 3, t if i % 7 else t.replace(" ", "\n")) for i, t in enumerate(values)] + [(1000, ""), (1001, values[5]), (1002, None), (1003, "y" * 20000)]
    frame = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, block string").repartition(3)
    rows = {x.doc_id: x for x in fingerprints.compare_edited(frame).collect()}
    plain = [(d, t or "") for d, t in docs]
    for (d, t), (_, after) in zip(plain, plain[1:] + plain[:1]):
        k = len(t) // 4
        edited = t[: len(t) - k] + after[:k]
        assert (rows[d].n_chars, rows[d].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (rows[d].fingerprint, rows[d].edited_fingerprint) == (plain_fingerprint(t), plain_fingerprint(edited))
        assert 0 <= rows[d].near_edited <= 1 and 0 <= rows[d].near_next <= 1
    assert rows[1001].fingerprint == rows[15].fingerprint


def test_blocks_of_neighbours(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")).repartition(5)
    rows = fingerprints.with_next(docs, "doc_id", "text", block_rows=20).collect()
    assert sorted((int(r.text), int(r.next_text)) for r in rows) == [(i, (i + 1) % 500) for i in range(500)]
    one = spark.createDataFrame([(None, "a")], "doc_id long, text string")
    assert [(r.text, r.next_text) for r in fingerprints.with_next(one, "doc_id", "text").collect()] == [("a", "a")]
    assert fingerprints.compare_edited(one.limit(0)).count() == 0


def test_fingerprints_ignore_order_and_can_be_updated(spark):
    rows = spark.createDataFrame([("a b\nc d\ne", "e\na b\nc d", "a b\ne", "c d")], "x string, y string, rest string, part string")
    x, y, rest, part = (fingerprints.fingerprint(F.col(c)) for c in ("x", "y", "rest", "part"))
    r = rows.select(x.alias("x"), y.alias("y"), rest.alias("rest"), part.alias("part")).select("x", "y", fingerprints.plus(F.col("rest"), F.col("part")).alias("sum"), fingerprints.minus(F.col("x"), F.col("part")).alias("less"), "rest").first()
    assert r.x.exact == r.y.exact == r.sum.exact and r.sum == r.x and r.less == r.rest


def test_edited_texts_are_nearer_than_next(spark, sf_dir):
    rows = fingerprints.query(spark, sf_dir).where("n_chars > 200").collect()
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.97
