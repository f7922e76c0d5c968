"""The trained operators row by row against plain versions of their formulas."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tenderlake.llm import language_id, quality

M = (1 << 64) - 1


def mix(h):
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & M
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & M
    return h ^ (h >> 31)


def grams(text):
    """Counts of hashed 1- to 3-grams of letters and single spaces."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    codes = [ord(c) for c in " " + "".join(w + " " for w in words)] if words else []
    one, two, three = 0x100000001B3, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
    keys = [mix((c * one + 1) & M) for c in codes]
    keys += [mix((a * one + b * two) & M) for a, b in zip(codes, codes[1:])]
    keys += [mix((a * one + b * two + c * three) & M) for a, b, c in zip(codes, codes[1:], codes[2:])]
    return Counter(k % language_id.DIMENSIONS for k in keys)


def tfidf(counts, idf):
    v = {f: (1 + math.log(n)) * idf(f) for f, n in counts.items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    return {f: x / norm for f, x in v.items()}


def softmax(logits, t=1.0):
    top = max(logits)
    e = [math.exp((x - top) / t) for x in logits]
    return [x / sum(e) for x in e]


ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1


def weight(z, n):
    return 0.0 if abs(z) <= L1 else -(z - math.copysign(L1, z)) / ((BETA + math.sqrt(n)) / ALPHA + L2)


def test_languages_by_plain_ftrl(spark):
    r = random.Random(3)
    vocabulary = {"xx": "the house of many words is here", "yy": "das haus mit vielen worten ist hier", "zz": "la maison de beaucoup des mots est ici"}
    rows = [(i, " ".join(r.choice(vocabulary[lang].split()) for _ in range(r.randint(3, 12))) + r.choice(["", " 12!", "\n", "  -- "]), lang) for i, lang in enumerate(r.choices(sorted(vocabulary), k=90))]
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x.doc_id: (x.lang_pred, x.score) for x in language_id.identify(known, known).collect()}

    counts = {i: grams(t) for i, t, _ in rows}
    df = Counter(f for c in counts.values() for f in c)
    idf = lambda f: math.log((1 + len(rows)) / (1 + df[f])) + 1
    vectors = {i: tfidf(c, idf) for i, c in counts.items()}
    languages = sorted(vocabulary)
    shard = {x.doc_id: x.s for x in known.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(10)).alias("s")).collect()}
    z, n = defaultdict(float), defaultdict(float)
    shards = sorted({s for s in shard.values() if s < 8})
    for _ in range(6):
        states = []
        for s in shards:
            oz, on = z.copy(), n.copy()
            own = []
            for i, _, lang in rows:
                if shard[i] == s:
                    f = sorted(vectors[i])
                    v = np.array([vectors[i][k] for k in f], "<f4")
                    own.append((np.array(f, "<i4").tobytes(), v.tobytes(), f, [float(x) for x in v], languages.index(lang)))
            own.sort(key=lambda x: x[:2])
            for at in np.random.default_rng(7).permutation(len(own)):
                _, _, f, v, label = own[at]
                w = {(k, c): weight(oz[k, c], on[k, c]) for k in f for c in range(3)}
                p = softmax([sum(x * w[k, c] for k, x in zip(f, v)) for c in range(3)])
                for k, x in zip(f, v):
                    for c in range(3):
                        g = x * (p[c] - (c == label))
                        sigma = (math.sqrt(on[k, c] + g * g) - math.sqrt(on[k, c])) / ALPHA
                        oz[k, c] += g - sigma * w[k, c]
                        on[k, c] += g * g
            states.append((oz, on))
        keys = {k for s in states for k in s[0]}
        z = defaultdict(float, {k: sum(s[0][k] for s in states) / len(states) for k in keys})
        n = defaultdict(float, {k: sum(s[1][k] for s in states) / len(states) for k in keys})
    w = {k: weight(z[k], n[k]) for k in z}
    logits = {i: [sum(x * w.get((f, c), 0.0) for f, x in v.items()) for c in range(3)] for i, v in vectors.items()}
    held = [(logits[i], languages.index(lang)) for i, _, lang in rows if shard[i] >= 8]
    loss = lambda t: -sum(math.log(softmax(x, t)[k]) for x, k in held)
    low, high = math.log(0.01), math.log(20)
    for _ in range(100):  # ternary search of the same convex loss
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(math.exp(a)) < loss(math.exp(b)) else (a, high)
    t = math.exp(low)
    assert held and len(got) == len(rows)
    for i, x in logits.items():
        p = softmax(x, t)
        assert got[i][0] == languages[p.index(max(p))] and abs(got[i][1] - max(p)) < 1e-3, (i, got[i], p)


TEXTS = ["", "One two, two three.\nOne two, two three.\n", "ABC def 123 $$$ | <x>", "é ü ñ wörter", "a b c d a b c d a b c", " \n\t "]


def plain_statistics(text):
    data, words = text.encode(), [w for w in __import__("re").findall(rb"[^\x20\x09-\x0D]+", text.encode())]
    shares = [sum(b in c.encode() for b in data) / max(len(data), 1) for c in quality.CLASSES] + [sum(b >= 128 for b in data) / max(len(data), 1)]
    out = [*shares, math.log1p(len(data))]
    if not words:
        return out + [0.0] * 13
    m, often = len(words), Counter(words)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / m
    threes = [tuple(words[i : i + 3]) for i in range(m - 2)]
    lines = [tuple(__import__("re").findall(rb"[^\x20\x09-\x0D]+", x)) for x in data.split(b"\n")]
    lines = [x for x in lines if x]
    upper = lambda b: 65 <= b <= 90
    alpha = lambda b: upper(b) or 97 <= b <= 122 or b >= 128
    symbols = (quality.CLASSES[6] + quality.CLASSES[7]).encode()
    p = [c / m for c in often.values()]
    return out + [
        math.log1p(m), mean, math.sqrt(sum((x - mean) ** 2 for x in lengths) / m), len(often) / m, max(often.values()) / m, -sum(x * math.log(x) for x in p),
        1 - len(set(threes)) / len(threes) if threes else 0.0, 1 - len(set(lines)) / len(lines), math.log1p(m / len(lines)),
        sum(len(w) > 1 and upper(w[0]) and upper(w[1]) for w in words) / m, sum(not alpha(w[-1]) for w in words) / m, sum(w[-1] in symbols for w in words) / m, sum(len(w) == 1 for w in words) / m,
    ]


def test_statistics_by_plain_counts():
    assert np.allclose(quality.statistics(pa.array(TEXTS)), [plain_statistics(t) for t in TEXTS])


def test_scores_by_plain_equations(spark):
    r = random.Random(9)
    good, bad = "a plain sentence of common words that reads well".split(), "BUY!!! $$$ click || now 99 <<>> %%".split()
    rows = [(i, " ".join(r.choice(good if r.random() < (0.85 if i % 2 else 0.25) else bad) for _ in range(r.randint(5, 40)))) for i in range(160)]
    labels = [(i, i % 2 if r.random() < 0.9 else 1 - i % 2, i % 4) for i in range(160) if i % 5]
    got = {x.doc_id: x.score for x in quality.score(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, label int, fold int")).collect()}

    stats = np.array([plain_statistics(t) for _, t in rows])
    at = [i for i, _, _ in labels]
    y, fold = np.array([y for _, y, _ in labels], float), np.array([f for _, _, f in labels])
    mean, deviation = stats[at].mean(axis=0), stats[at].std(axis=0)
    rng = np.random.default_rng(11)
    directions = rng.normal(size=(len(mean), 256)) / (0.7 * np.sqrt(len(mean)))
    phases = rng.uniform(0, 2 * np.pi, 256)
    scaled = np.clip((stats - mean) / np.maximum(deviation, 1e-6), -6, 6)
    x = np.hstack([np.sqrt(2 / 256) * np.cos(scaled @ directions + phases), np.ones((len(rows), 1))])

    def ridge(own):
        a = x[at][own]
        return np.linalg.solve(a.T @ a + np.diag([1.0] * 256 + [1e-3]), a.T @ y[own])

    unseen = np.array([x[i] @ ridge(fold != f) for i, f in zip(at, fold)])
    bins = defaultdict(lambda: [0, 0.0])
    for s, label in zip(unseen, y):
        b = bins[int(min(max((s + 0.5) / 2 * 2048, 0), 2047))]
        b[0] += 1
        b[1] += label
    places = sorted(bins)
    n, total = np.array([bins[b][0] for b in places], float), np.array([bins[b][1] for b in places])
    # the isotonic value of a place is the largest of the smallest means over the runs around it
    value = [max(min(total[i : k + 1].sum() / n[i : k + 1].sum() for k in range(j, len(places))) for i in range(j + 1)) for j in range(len(places))]
    xs, ys, j = [], [], 0
    while j < len(places):
        k = j
        while k + 1 < len(places) and abs(value[k + 1] - value[j]) < 1e-12:
            k += 1
        own = slice(j, k + 1)
        centre = np.array([-0.5 + (b + 0.5) / 2048 * 2 for b in places[own]])
        xs.append((centre * n[own]).sum() / n[own].sum())
        ys.append((total[own].sum() + 0.5) / (n[own].sum() + 1))
        j = k + 1
    want = np.clip(np.interp(x @ ridge(fold >= 0), xs, ys), 0, 1)
    assert len(set(np.round(want, 3))) > 3
    assert max(abs(got[i] - want[i]) for i in range(160)) < 1e-6
