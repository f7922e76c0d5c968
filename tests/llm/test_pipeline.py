"""Each stage of the pipeline against a plain version on what its predecessor kept."""

import corpus_pipeline
from tests.llm import brute


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "ngram_jaccard_join", "substring_dedup", "packing"]
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, sf_dir), name)
        rows = docs.collect()
        if name == "packing":
            assert {r.doc_id for r in rows} == set(before)
            break
        after = {r.doc_id: r for r in rows}
        assert docs.columns == list(corpus_pipeline.COLUMNS) and len(after) == len(rows)
        assert all((r.lang, r.source) == (before[d].lang, before[d].source) for d, r in after.items())
        assert all(r.n_chars == len(r.text) for r in rows)
        plain = [(d, r.text) for d, r in before.items()]
        if name == "quality_classifier":
            assert all(r.text == before[d].text for d, r in after.items()) and 0.7 < len(after) / len(before) < 1
        elif name == "line_dedup":
            assert {(d, brute.sha(r.text)) for d, r in after.items()} == {(d, s) for d, _, _, s in brute.line_dedup(plain)}
        elif name == "ngram_jaccard_join":
            assert set(after) == {d for d, _, c in brute.jaccard(plain) if d == c}
            assert all(r.text == before[d].text for d, r in after.items())
        else:
            for d, _, gone, s in brute.substring_dedup(plain):
                assert after[d].text == before[d].text if not gone else brute.sha(after[d].text) == s
        before = after


def odd_rows(spark):
    long = " ".join(f"t{i % 977} {'abc'[i % 3]}" for i in range(60_000))
    texts = [(None, None), (None, "one two three four five six"), (1, None), (2, ""), (3, " \n\n "), (4, "a tie\na tie\nof lines that are the same"), (4, "a tie\na tie\nof lines that are the same"), (4, "another text of one id"), (5, long), (6, long)]
    texts += [(7 + i, "the same words in every row of these copies, over and over\n" * 3) for i in range(5)]
    return spark.createDataFrame([(d, t, None, "s", 0, "x", -1) for d, t in texts], "doc_id long, text string, lang string, source string, n_chars long, n_words string, __group int")


def test_stages_on_odd_rows(spark, sf_dir):
    docs = odd_rows(spark)
    was = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        got = sorted(((r.doc_id, r["text"]) for r in out.collect()), key=repr) if name != "packing" else sorted((r.doc_id for r in out.select("doc_id").distinct().collect()), key=repr)
        if name == "packing":
            assert set(got) == {d for d, _ in was}
            continue
        assert out.columns == list(corpus_pipeline.COLUMNS)
        if name == "quality_classifier":
            assert set(got) <= set(was) and len(got) <= len(was)
        elif name == "line_dedup":
            assert [d for d, _ in got] == [d for d, _ in was] and None not in [t for _, t in got]
            assert sum("a tie" in t for _, t in got) == 0 or sum(t.count("a tie") for _, t in got) == 1
            assert sum(t.count("the same words in every row") for _, t in got) == 1
        elif name == "ngram_jaccard_join":
            keep = {d for d, _, c in brute.jaccard(was) if d == c}
            assert {d for d, _ in got} == keep and 6 not in keep and 5 in keep
        else:
            want = {(d, s) for d, _, _, s in brute.substring_dedup(was)}
            assert {(d, brute.sha(" ".join(brute.WORD.findall(t)))) for d, t in got} == want


def test_stages_of_an_empty_table(spark, sf_dir):
    docs = odd_rows(spark).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0 and (name == "packing" or out.columns == list(corpus_pipeline.COLUMNS))
