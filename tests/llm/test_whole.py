"""The queries do their whole jobs: compared with plain versions that leave nothing out."""

import numpy as np

from tenderlake.llm import line_dedup, search
from tests.llm import brute
from tests.llm.test_models import brute_search


def test_every_20th_document_is_searched_for(spark, sf_dir):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    asked = [(d, t) for d, t in docs if d % 20 == 0]
    got = sorted((r.query_id, r.rank, r.doc_id, r.score) for r in search.query(spark, sf_dir).collect())
    want = sorted(brute_search(docs, asked, 100))
    assert len({r[0] for r in got}) == len(asked) and [r[:3] for r in got] == [r[:3] for r in want]
    assert all(abs(a[3] - b[3]) <= 2e-6 for a, b in zip(got, want))


def test_search_reads_postings_of_chosen_blocks_only(monkeypatch):
    r = np.random.default_rng(1)
    docs, block = 640, 64
    lengths = np.where(np.arange(docs) // block == 3, 2, 40)  # short documents score best: block 3 holds all results
    doc = np.repeat(np.arange(docs), lengths)
    first = np.append(True, doc[1:] != doc[:-1])
    hashes = np.where(first, 7, r.integers(100, 10**6, len(doc))).astype(np.uint64)
    shard = search.Shard(np.arange(docs), hashes, doc, lengths.mean(), block)
    shard.weigh(np.ones(len(shard.terms)))
    opened = []
    plain = search.Shard.scores_in
    monkeypatch.setattr(search.Shard, "scores_in", lambda self, b, runs, rows: opened.append((b, int(self.lengths[runs].sum()))) or plain(self, b, runs, rows))
    _, scores = shard.best(np.array([7], np.uint64), 10)
    term = slice(shard.start[0], shard.end[0])
    want = np.sort(shard.impact[term])[::-1][:10]
    assert np.array_equal(np.sort(scores)[::-1][:10], want)
    assert len(opened) <= 4 and sum(n for _, n in opened) <= 4 * block < shard.end[0] - shard.start[0]
    # terms of one document each: cursors jump to the blocks that hold them
    opened.clear()
    rare = np.flatnonzero(shard.end - shard.start == 1)[:3]
    found, scores = shard.best(shard.terms[rare], 10)
    assert sorted(found) == sorted(set(shard.doc[shard.start[rare]])) and {b for b, _ in opened} == {d // block for d in found}
    # with a threshold that only a document with all terms reaches, most are never opened
    opened.clear()
    many = np.unique(hashes[doc == 17])
    found, scores = shard.best(many, 1)
    assert shard.ids[found[scores.argmax()]] == 17 and len(opened) < shard.blocks


def test_short_lines_are_compared(spark):
    docs = [(1, "MIT\nAll rights reserved.\nReleased under the MIT License.\n\na b"), (2, "MIT\n  All rights  reserved.\nReleased under the BSD License.\n\na c\nGPL"), (3, "All rights reserved\na b c\na b\nAll rights are reserved.\n")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in line_dedup.dedup_lines(frame).collect()}
    assert got == {1: docs[0][1], 2: "\na c\nGPL", 3: "a b c\n"}


def test_lines_of_the_table(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, line_dedup.query(spark, sf_dir).collect())) == sorted(brute.line_dedup(docs))


def test_candidates_do_not_grow_with_the_shards(spark, monkeypatch):
    cores, k = spark.sparkContext.defaultParallelism, 3
    docs = [(i, f"a b c{i % 7} d{i % 11}") for i in range(30 * cores)]
    asked = [(d, t) for d, t in docs if d % 20 == 0]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3 * cores)
    left, plain = [], search._found
    monkeypatch.setattr(search, "TASKS", 1, raising=False)
    monkeypatch.setattr(search, "_found", lambda *a: left.append(plain(*a).count()) or plain(*a))
    got = search.top_k(frame, frame.where("doc_id % 20 = 0"), k=k, query_id="doc_id").collect()
    assert sorted((x.query_id, x.rank, x.doc_id, round(x.score, 6)) for x in got) == sorted(brute_search(docs, asked, k))
    assert 0 < left[0] <= len(asked) * k * cores  # and not once for each of the shards


def test_an_index_is_read_as_it_was_built():
    r = np.random.default_rng(3)
    doc = np.sort(r.integers(0, 300, 5000))
    hashes = (r.zipf(1.3, 5000) % 400).astype(np.uint64)
    built, some = search.Shard(np.arange(300) - 5, hashes, doc, 16.0, 64), np.arange(0, 400, 3).astype(np.uint64)
    read = search.Shard.of_row(built.row(), some, 16.0, 64)
    keep = np.repeat(np.isin(built.terms, some), built.end - built.start)
    assert np.array_equal(read.ids, built.ids) and np.array_equal(read.terms, built.terms[np.isin(built.terms, some)])
    assert np.array_equal(read.doc, built.doc[keep]) and np.array_equal(read.impact, built.impact[keep])
