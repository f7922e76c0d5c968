import random

import pytest

from tenderlake.llm import jaccard_join, line_dedup, substring_dedup
from tests.llm import brute


def documents(spark, sf_dir):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, n_words string, __group int")


def digest(df, *cols):
    from pyspark.sql import functions as F

    return df.select(*cols, F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


@pytest.mark.parametrize("module, plain", [(substring_dedup, brute.substring_dedup), (line_dedup, brute.line_dedup), (jaccard_join, brute.jaccard)])
def test_query_on_the_table(spark, sf_dir, module, plain):
    assert rows(module.query(spark, sf_dir)) == sorted(plain(documents(spark, sf_dir)), key=repr)


def mixed(seed):
    """Copies, shifted passages, edited lines, nulls, empty texts, repeated rows and ids, white space of all kinds."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", " ", "的", "x" * 30]
    passage = [r.choice(vocabulary) for _ in range(60)]
    docs = [(None, "a b c"), (None, None), (5, ""), (5, "a b c"), (5, "a b c"), (6, " \t\n\r "), (7, "one")]
    base = [r.choice(vocabulary) for _ in range(80)]
    for i in range(10, 60):
        w = [r.choice(vocabulary) for _ in range(r.randint(1, 60))]
        if i % 3 == 0:
            k = r.randint(0, 30)
            w[r.randint(0, len(w)) :] = passage[k : k + r.randint(15, 30)]
        if i % 4 == 0:
            w = list(base)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = "edit"
        seps = [" ", "  ", "\t", "\r\n", "\n", "\n"]
        docs.append((i, "".join(x + (r.choice(seps) if r.random() < 0.1 else " ") for x in w)))
    return docs + [docs[-1], (100, docs[20][1]), (101, docs[20][1].upper())]


@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_of_mixed_rows(spark, seed):
    got = digest(substring_dedup.dedup_substrings(frame(spark, mixed(seed))), "doc_id", "n_words", "n_removed")
    assert rows(got) == sorted(brute.substring_dedup(mixed(seed)), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_of_mixed_rows(spark, seed):
    r = random.Random(seed)
    docs = mixed(seed)
    line = [f"v{i}" for i in range(12)]
    for i in range(200, 260):
        lines = []
        for _ in range(r.randint(0, 4)):
            w = list(line)
            kind = r.randrange(5)
            if kind == 1:
                w[r.randrange(12)] = f"new{r.randrange(3)}"
            elif kind == 2:
                del w[r.randrange(12)]
            elif kind == 3:
                w.insert(r.randrange(13), f"new{r.randrange(3)}")
            elif kind == 4:
                r.shuffle(w)
                w = w[: r.randint(1, 12)]
            lines.append(" ".join(w))
        docs.append((i, "\n".join(lines)))
    got = digest(line_dedup.dedup_lines(frame(spark, docs)), "doc_id", "n_lines", "n_removed")
    assert rows(got) == sorted(brute.line_dedup(docs), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_of_mixed_rows(spark, seed):
    r = random.Random(seed)
    docs = mixed(seed)
    base = [f"b{i}" for i in range(60)]
    for i in range(300, 380):  # chains of edits, so that some pairs are just above and some just below
        w = list(base)
        for _ in range(r.randint(1, 3)):
            w[r.randrange(60)] = f"e{r.randrange(50)}"
        docs.append((i, " ".join(w)))
        if i % 10 == 0:
            base = w
    assert rows(jaccard_join.jaccard_components(frame(spark, docs))) == sorted(brute.jaccard(docs), key=repr)


@pytest.mark.parametrize("operator", [substring_dedup.dedup_substrings, line_dedup.dedup_lines, jaccard_join.jaccard_components])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).count() == 0


def test_kept_columns(spark):
    docs = frame(spark, mixed(3)).withColumnRenamed("n_words", "source")
    for operator in (substring_dedup.dedup_substrings, line_dedup.dedup_lines):
        out = operator(docs, keep=("source", "__group", "text"))
        assert out.columns[-2:] == ["source", "__group"]
        assert out.where("source = 'x'").count() == docs.count()


def test_jaccard_of_large_groups_of_copies(spark, monkeypatch):
    """Exact copies, near copies at every distance from their original, and copies that share deletions."""
    monkeypatch.setattr(jaccard_join, "GROUP_CLASSES", 8)
    monkeypatch.setattr(jaccard_join, "PORTION", 16)
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    docs = []
    for base in range(3):
        original = [r.choice(vocabulary) for _ in range(60)]
        docs += [" ".join(original)] * 40
        for _ in range(70):
            copy = list(original)
            for _ in range(r.randrange(1, 6)):
                copy[r.randrange(0, 30)] = r.choice(vocabulary[:4])  # few places, few words: edits are shared
            if r.random() < 0.3:
                del copy[r.randrange(40) : r.randrange(41, 60)]
            docs.append(" ".join(copy))
    r.shuffle(docs)
    docs = list(enumerate(docs))
    assert rows(jaccard_join.jaccard_components(frame(spark, docs))) == sorted(brute.jaccard(docs), key=repr)
