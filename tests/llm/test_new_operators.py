"""Collocations, minimum-bin-slack packing and hard negatives against plain versions, on odd rows too."""

import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tenderlake.llm import collocations as C
from tenderlake.llm import hard_negatives as H
from tenderlake.llm import slack_packing as P

# --- collocations -------------------------------------------------------------------------------------------------


def plain_collocations(rows, least, within=100, top=2000, words=5):
    total, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = [x for x in re.split("[ \t]+", piece) if x]
            total[lang] += len(w)
            for i in range(len(w)):
                for m in range(1, words + 1):
                    if i + m <= len(w):
                        f[lang, tuple(w[i : i + m])] += 1
    frequent = {k: n for k, n in f.items() if n >= least}
    out = defaultdict(list)
    for (lang, p), a in frequent.items():
        if len(p) < 2:
            continue
        if any(other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * b >= within * a for (other, q), b in frequent.items()):
            continue
        cuts = [(1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def texts_of(seed, n=120):
    rng, some = random.Random(seed), ["a", "b", "Cc", "d\x00", "é", "ß", " ", "x-y", "ZZ"]
    rows = [("".join(rng.choice(some) + rng.choice([" ", "  ", "\t", ". ", ",", "\n", " "]) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None, "und", ""])) for _ in range(n)]
    return [*rows, (None, "en"), ("", None), ("a b " * 3000, "fr"), ("one" * 2000, "fr"), *[("Same text here, again", "en")] * 9]


DOCS = "text string, lang string"


@pytest.mark.parametrize("seed,budget,within,top", [(1, 1 << 20, 100, 2000), (2, 40, 100, 2000), (3, 8, 60, 3)])
def test_collocations(spark, seed, budget, within, top):
    rows = texts_of(seed)
    docs = spark.createDataFrame(rows, DOCS).withColumn("phrase", F.lit("x")).withColumn("f", F.lit(1)).withColumn("size", F.lit(2)).repartition(3)
    got = C.collocations(docs, least=6, within=within, top=top, budget=budget).collect()
    assert sorted(map(tuple, got)) == plain_collocations(rows, 6, within, top)


def test_collocations_of_nothing(spark):
    assert C.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert C.collocations(spark.createDataFrame([(None, None), ("", "en"), (" ,. ", "en")], DOCS)).collect() == []


def test_small_budgets_split_prefixes_and_keep_counts(spark, monkeypatch):
    monkeypatch.setattr(C, "CHUNK", 200)  # many chunks, in which no prefix is heavy by itself
    docs = spark.createDataFrame(texts_of(5), DOCS)
    few, many = (C.phrase_counts(docs, least=3, budget=b).collect() for b in (1 << 20, 20))
    assert sorted(map(tuple, few)) == sorted(map(tuple, many)) and len(few) > 50
    n, heavy = C.heavy_prefixes(docs.select(F.col("text"), F.coalesce("lang", F.lit("und")).alias("lang")), 5, 20, 20_000)
    assert n == sum(r["f"] for r in few if r["size"] == 0) and all(len(h) for h in heavy)


def test_scores_beyond_64_bits(spark):
    a, n, l, r = 10**13, 10**15, 10**13 + 1, 10**13 + 3
    score = F.expr(C.SCORE)
    got = spark.createDataFrame([(a, n, l, r)], "a long, n long, l long, r long").select(score).first()[0]
    assert got == 1000 * a * n // (l * r)


# --- packing ------------------------------------------------------------------------------------------------------


def check_windows(rows, docs, capacity):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for doc, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want.update((doc, k, i, j - i, zlib.crc32(struct.pack(f"<{j - i}I", *ids[i:j]))) for k, (i, j) in enumerate(zip(cuts, cuts[1:])))
    assert Counter(tuple(r)[:5] for r in rows) == want
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    return len(bins), sum(r["length"] for r in rows)


@pytest.mark.parametrize("group_bytes", [32 << 20, 500])
def test_best_fit(spark, group_bytes):
    rng = random.Random(4)
    words = ["tender", "lot's", " 12,5", "Ünit", "\n", "  ", "<|endoftext|>", "x" * 40, "あい", "\x00"]
    docs = [(i % 50 if i % 7 else None, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(150)]
    docs += [(1, None), (2, ""), (3, "long " * 900), (4, "y" * 3000), *[(None, "same copy")] * 40, *[(9, "same copy")] * 40]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("z") for c in ("piece", "copy", "again", "offset", "__group")}).repartition(4)
    out = P.best_fit(frame, public_tokenizers.path("byte_bpe_50k.json"), capacity=128, group_bytes=group_bytes)
    bins, tokens = check_windows(out.collect(), docs, 128)
    assert bins <= 1.02 * -(-tokens // 128) + 1
    assert [f.simpleString() for f in out.schema][:3] == ["doc_id:bigint", "piece:int", "start:bigint"]


def test_best_fit_of_the_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    bins, tokens = check_windows(P.query(spark, sf_dir).collect(), docs, 1024)
    assert bins <= 1.02 * -(-tokens // 1024) + 1


def test_best_fit_of_a_batch_that_is_encoded_in_portions(spark):
    docs = [(i, f"{i} lot " * (70_000 + i)) for i in range(8)] + [(8, "tail"), (9, " \n" * 1_500_000 + "x")]
    rows = P.best_fit(spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), public_tokenizers.path("byte_bpe_50k.json")).collect()
    check_windows(rows, docs, 1024)


def test_best_fit_of_nothing(spark):
    assert P.best_fit(spark.createDataFrame([], "doc_id long, text string"), public_tokenizers.path("byte_bpe_50k.json")).collect() == []


def test_each_window_is_the_fullest():
    def fullest(lengths, room):
        sums = {0}
        for n in lengths:
            sums |= {s + n for s in sums if s + n <= room}
        return max(sums)

    for seed in range(30):
        rng = random.Random(seed)
        capacity = rng.choice([20, 97])
        lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(40))]
        left = sorted(lengths)
        got = P.windows(lengths, capacity)
        assert sorted(i for w in got for i in w) == list(range(len(lengths)))
        for w in got:
            assert lengths[w[0]] == left.pop()
            room = capacity - lengths[w[0]]
            assert sum(lengths[i] for i in w[1:]) == fullest(left, room)
            for i in w[1:]:
                left.remove(lengths[i])


def test_encoding_by_ranks_is_that_of_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, library, rng = P.ByteEncoder(path), Tokenizer.from_file(path), random.Random(1)
    assert own.ranks is not None
    parts = ["a", "B", "é", "Ā", "'s", "'", "’", " ", " ", "\u00a0", "\n", "\t", "<|endoftext|>", "1", "٣", "あ", "\x85", "-", "!!", "x" * 9, "\x00", "don't", "tion", "zzz", "==="]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(3000)] + ["y" * 5000, "ab" * 2000 + " c"]
    assert [x.tolist() for x in own.encode(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    own.merges.side_by_side = own.merges.follows = lambda *a: False  # then nothing is taken from the ranks
    own.good = own.good[:0]
    whole, used = own.whole, []
    own.whole = lambda text: used.append(text) or whole(text)
    assert [x.tolist() for x in own.encode(texts[:200])] == [x.ids for x in library.encode_batch(texts[:200], add_special_tokens=False)]
    assert len(used) > 100


# --- hard negatives -----------------------------------------------------------------------------------------------


def plain_negatives(rows, anchor, positives=5, negatives=3):
    good = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, tuple(math.floor(256 * x) for x in v), label))
    out = []
    for i, v, label in {g for g in good if anchor(g[0])}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for j, w, m in good)
        for s, p, _ in [x for x in scored if x[2] == label and x[1] != i][:positives]:
            near = [(j, t) for t, j, m in scored if m != label and 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out += [(i, p, k + 1, j, -s, -t) for k, (j, t) in enumerate(near)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<float>, label int"


def vectors_of(seed, n=160, dims=7):
    rng = np.random.default_rng(seed)
    rows = [(i, [*map(float, rng.normal(0, 0.4, dims).astype(np.float32))], int(rng.integers(3))) for i in range(n)]
    hot = rows[1][1]
    rows += [(1000 + i, hot, i % 2) for i in range(60)]  # ties: one vector under many ids
    rows += [(5, rows[5][1], rows[5][2])] * 9 + [(20, rows[20][1], rows[20][2])] * 2 + [(20, rows[30][1], 1)]  # repeated ids, anchors too
    rows += [(2000, [], 0), (2010, [0.5], 1), (2020, [1.0] * 9, 2), (2030, [0.0] * dims, 0)]  # other lengths
    rows += [(None, hot, 1), (3000, None, 1), (3010, [None] + hot[1:], 1), (3020, [float("nan")] * dims, 1), (3030, [float("-inf")] * dims, 1), (3040, hot, None)]
    return rows


@pytest.mark.parametrize("how", [{}, {"block": 16, "portion": 4}])
def test_hard_negatives(spark, how):
    rows = vectors_of(1)
    frame = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("z") for c in ("id", "vector", "norm", "rank", "__tile")}).repartition(3)
    got = H.hard_negatives(frame, F.col("id") % 10 == 0, **how).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_hard_negatives_of_few_rows(spark):
    empty = H.hard_negatives(spark.createDataFrame([], VECTORS), F.col("id") % 10 == 0)
    assert empty.collect() == [] and empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    one = spark.createDataFrame([(10, [1.0], 1), (11, [1.0], 2), (1, [1e30], 1)], VECTORS)  # the last is too long to be scored
    assert H.hard_negatives(one, F.col("id") % 10 == 0).collect() == []


@pytest.mark.parametrize("size", [1, 100, 40_000, 1 << 25])
def test_packed_products_are_exact(size):
    rng = np.random.default_rng(size)
    x, a = rng.integers(-size, size + 1, (101, 6)), rng.integers(-size, size + 1, (13, 6))
    norm = int(max((x * x).sum(1).max(), (a * a).sum(1).max()))
    fields = H.Fields(x, norm, size)
    assert (fields.scores(a) == a @ x.T).all()
    assert fields.per == max(1, 64 // fields.width) and (size > 100 or fields.per > 1)


def test_first_of_ties():
    scores = np.array([[5, 7, 7, 7, H.NONE], [H.NONE] * 5, [1, 1, 1, 1, 1]])
    row, col = H.first(scores, 2)
    assert list(zip(row, col)) == [(0, 1), (0, 2), (2, 0), (2, 1)]
    assert H.vectors(pa.chunked_array([[[1, 2], [], [3]]]), 3).tolist() == [[1, 2, 0], [0, 0, 0], [3, 0, 0]]
