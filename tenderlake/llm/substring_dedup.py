"""Substring deduplication with fixed-block anchors.

A repeat of ``window`` words covers, wherever it lies in the earlier document, at
least one of that document's non-overlapping blocks of ``window // 2`` words.
So the index holds those blocks only, and every rolling window of the block's
length probes it. Hits are extended: the full windows around hits are compared
by wide hashes, the earliest place of each is kept, and overlapping repeated
windows grow together to maximal exact repeats, whose words are removed.

Semantics. Order is (doc_id with null first, text for rows of one id, position).
A word goes if a window of the input that covers it starts earlier elsewhere
too. Null or empty texts have no words. Repeated rows are documents of their
own. Extra columns are ignored unless named in ``keep``; an output column takes
precedence over a kept one of the same name.
"""

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm import groups as G
from tenderlake.llm import words as W




def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, keep: tuple[str, ...] = (), verbatim: bool = False) -> DataFrame:
    """Columns: doc_id, n_words, n_removed, kept_text (kept words joined by one space), and ``keep``.

    With ``verbatim``, texts that lose nothing are returned unchanged.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    block = window // 2
    keep = tuple(c for c in keep if c not in ("doc_id", "text", "n_words", "n_removed", "kept_text", id_col, text_col))
    lay = G.layout(docs, text_col)
    dealt = G.grouped(docs, lay, id_col, text_col, keep)

    def anchors(table: pa.Table) -> pa.Table:
        group, keys, marks = table[G.GROUP][0].as_py(), [], []
        for _, w in G.text_slices(G.sorted_docs(table)):
            h, whole = W.windows(w.hashes(), w.doc, block, seed=1)
            place = np.arange(len(h)) - w.first[w.doc[: len(h)]]
            keys.append(G.short_key(h[whole], lay.buckets))
            marks.append((place % block == 0)[whole])
        return G.presence(np.concatenate(keys), np.concatenate(marks), group)

    def wide(w: W.Words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, whole = W.windows(hashes, w.doc, window, seed=2)
        b, _ = W.windows(hashes, w.doc, window, seed=3)
        return a, b % np.uint64(lay.buckets), whole

    def extend(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table) or not len(answers):
            return G.empty(G.PACKED)
        hits, table = G.keys_in(answers), G.sorted_docs(table)
        ids, found = G.ids_of(table), []
        for d, w in G.text_slices(table):
            hashes = w.hashes()
            h, whole = W.windows(hashes, w.doc, block, seed=1)
            hit = whole & G.member(G.short_key(h, lay.buckets), hits)
            a, b, full = wide(w, hashes)
            seen = np.concatenate([[0], np.cumsum(hit)])
            n = len(a)
            near = seen[window - block + 1 : window - block + 1 + n] > seen[:n]
            at = np.flatnonzero(full & near)
            found.append((a[at], b[at], ids[d + w.doc[at]]))
        a, b, doc = (np.concatenate(x) for x in zip(*found))
        if not len(a):
            return G.empty(G.PACKED)
        order = np.lexsort((a, b))  # stable: the earliest of equal windows comes first
        first = np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])
        pick = np.sort(order[first])
        pick = pick[np.argsort(b[pick], kind="stable")]
        a, b, doc = a[pick], b[pick], doc[pick]
        return G.packed(b.astype(np.int64), answers[G.GROUP][0].as_py(), a, lambda i, j: G.squeeze(doc[i:j]))

    def earliest(table: pa.Table) -> pa.Table:
        a = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        doc = np.concatenate([G.unsqueeze(x) for x in table["extra"].to_pylist()])
        size, a = np.array([len(x) for x in a]), np.concatenate(a)
        order = np.argsort(a)
        at, n = G.runs(a[order])
        lost = np.zeros(len(a), bool)
        lost[order] = doc[order] != np.repeat(np.minimum.reduceat(doc[order], at), n)
        ends, bucket = np.cumsum(size), table[G.BUCKET][0].as_py()
        out = [(g, a[e - k : e][lost[e - k : e]].tobytes()) for g, e, k in zip(table[G.GROUP].to_pylist(), ends, size)]
        out = [(g, x) for g, x in out if x]
        return pa.table({G.GROUP: pa.array([g for g, _ in out], pa.int32()), G.BUCKET: pa.array([bucket] * len(out), pa.int32()), "hashes": pa.array([x for _, x in out], pa.binary())})

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = G.sorted_docs(table)
        parts = [(np.frombuffer(x, np.uint64), b) for b, x in zip(answers[G.BUCKET].to_pylist(), answers["hashes"].to_pylist())]
        fold = lambda a, b: W.mix(a ^ b.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        lost = np.sort(np.concatenate([fold(a, np.full(len(a), b)) for a, b in parts])) if parts else np.zeros(0, np.uint64)
        every = []
        for d, w in G.text_slices(table):
            a, b, full = wide(w, w.hashes())
            every.append((d, w, fold(a, b), full))
        key = np.concatenate([k[f] for _, _, k, f in every])
        gone = G.member(key, lost)
        order = np.argsort(key, kind="stable")
        again = np.zeros(len(key), bool)
        again[order[1:]] = key[order][1:] == key[order][:-1]
        gone |= again
        n_words, n_removed, kept, at = [], [], [], 0
        for _, w, _, full in every:
            go = np.zeros(len(full), bool)
            go[full] = gone[at : at + full.sum()]
            at += int(full.sum())
            step = np.zeros(len(w.doc) + 1, np.int64)
            step[: len(go)] += go
            step[window : window + len(go)] -= go
            stay = np.cumsum(step)[:-1] == 0
            for k, (i, j) in enumerate(itertools.pairwise(w.first.tolist())):
                n_words.append(j - i)
                rest = stay[i:j]
                left = int(rest.sum())
                n_removed.append(j - i - left)
                if verbatim and left == j - i:
                    kept.append(w.data[w.begin[k] : w.begin[k + 1]].tobytes())
                    continue
                own = w.data[w.starts[i] : w.ends[j - 1]].tobytes().split() if j > i else []
                kept.append(b" ".join(own if left == j - i else itertools.compress(own, rest)))
        new = {"doc_id": table["doc_id"], "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())}
        return pa.table(new | {c: table[f"__kept_{c}"] for c in keep})

    hits = G.shared(dealt.groupBy(G.GROUP).applyInArrow(anchors, G.PACKED), need_mark=True)
    plain = dealt.select(G.GROUP, "doc_id", "text") if keep else dealt
    candidates = plain.groupBy(G.GROUP).cogroup(hits.groupBy(G.GROUP)).applyInArrow(extend, G.PACKED)
    lost = candidates.groupBy(G.BUCKET).applyInArrow(earliest, f"{G.GROUP} int, {G.BUCKET} int, hashes binary")
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_text string" + "".join(f", `{c}` {kinds[c]}" for c in keep)
    return dealt.groupBy(G.GROUP).cogroup(lost.groupBy(G.GROUP)).applyInArrow(cut, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = dedup_substrings(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), starts AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS p FROM words WHERE len(w) >= 20
), windows AS (SELECT doc_id, p, array_to_string(list_slice(w, p, p + 19), ' ') AS seq FROM starts
), repeated AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY seq ORDER BY doc_id, p) AS rn FROM windows) WHERE rn > 1
), gone AS (SELECT DISTINCT doc_id, unnest(generate_series(p, p + 19)) AS pos FROM repeated
), every AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM words
), kept AS (SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.pos) AS text, count(*) AS n FROM every e LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.pos = e.pos WHERE g.pos IS NULL GROUP BY 1)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM words LEFT JOIN kept ON kept.doc_id = words.doc_id
"""
