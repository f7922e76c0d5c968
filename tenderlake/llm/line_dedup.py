"""Line deduplication by a deletion-neighbourhood join over words.

Two lines are near when at most one word is inserted, deleted or replaced. Every
line emits the hash of itself and of all its variants with one word deleted;
near lines share one of them, so only lines with a shared variant are looked at
again. There the shared variants are typed, which verifies the distance:

* the line itself equals another line, or a variant of a line one word longer:
  distance 0 or 1;
* variants of equally long lines with the deletion at the same position are
  equal: the lines differ in that word at most. Equal variants from different
  positions prove no distance of one and are not joined.

A line goes if a line near to it comes earlier in the input; the earliest stays.
A hash group is reduced to its earliest lines, inside a group of documents and
then across groups, so no pairs are formed.

Semantics. Lines end at line feeds and are compared by their words (white space
is ignored). Lines of fewer than ``near_words`` words go only if an equal line is
earlier, and no other line goes because of them: from three words on, one edit
leaves most of a line's words equal. Lines without words stay. Order is (doc_id with
null first, text for rows of one id, line). Null text counts as empty: no lines,
empty kept text. Extra columns are ignored unless named in ``keep``; an output
column takes precedence over a kept one of the same name.
"""

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm import groups as G
from tenderlake.llm import words as W

_RADIX, _SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
FULL, SHORTER, REPLACED = 0, 1, 2


@dataclass
class Lines:
    """Lines with words, in order; and of each of their words the line and the variant without it."""

    whole: np.ndarray  #: hash of each line
    doc: np.ndarray  #: position of its document in the group
    number: np.ndarray  #: which line of the document
    near: np.ndarray  #: whether it has words enough for a distance of one
    line: np.ndarray  #: of each word of such lines
    variant: np.ndarray  #: of each of these words: the line without it
    typed: np.ndarray  #: the same with length and position


def lines_of(table: pa.Table, near_words: int) -> Lines:
    parts = []
    for d, w in G.text_slices(table):
        h, n_all = w.hashes(), len(w.starts)
        feeds = np.flatnonzero(w.data == 10)
        at = np.searchsorted(feeds, w.starts)
        start, n = G.runs(at + w.doc)
        use = np.repeat(n >= near_words, n)
        place = np.arange(n_all) - np.repeat(start, n)
        power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(int(n.max(initial=0)), _RADIX)]))
        total = np.concatenate([[np.uint64(0)], np.cumsum(h * power[place])])
        whole = total[start + n] - total[start]
        s, e = np.repeat(total[start], n), np.repeat(total[start + n], n)
        size = np.repeat(n, n).astype(np.uint64)
        variant = W.mix(total[:-1] - s + (e - total[1:]) * _INVERSE + (size - np.uint64(1)) * _SALT)
        typed = W.mix(variant + size * _RADIX + (place.astype(np.uint64) + np.uint64(1)) * _SALT)
        doc = w.doc[start]
        # the first line of a document has number 0: line feeds before the document do not count
        first_feed = at[start] - np.searchsorted(feeds, w.begin[doc])
        parts.append((W.mix(whole + n.astype(np.uint64) * _SALT), (d + doc), first_feed, n >= near_words, np.repeat(np.arange(len(n)), n)[use], variant[use], typed[use]))
    base = np.cumsum([0] + [len(p[0]) for p in parts])
    return Lines(*(np.concatenate([p[k] + (b if k == 4 else 0) if k != 3 else p[k] for p, b in zip(parts, base)]) for k in range(7)))


def firsts(whole: np.ndarray) -> np.ndarray:
    """Whether a line is the first of its equals."""
    order = np.argsort(whole, kind="stable")
    out = np.zeros(len(whole), bool)
    out[order[G.runs(whole[order])[0]]] = True
    return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), near_words: int = 3) -> DataFrame:
    """Columns: doc_id, n_lines, n_removed, kept_text (kept lines joined by line feeds), and ``keep``."""
    if near_words < 2:
        raise ValueError("lines that may differ by a word have two words at least")
    keep = tuple(c for c in keep if c not in ("doc_id", "text", "n_lines", "n_removed", "kept_text", id_col, text_col))
    lay = G.layout(docs, text_col)
    dealt = G.grouped(docs, lay, id_col, text_col, keep)
    plain = dealt.select(G.GROUP, "doc_id", "text") if keep else dealt
    bucket_of = lambda h: ((h >> np.uint64(32)) % np.uint64(lay.buckets)).astype(np.int64)

    def wholes(table: pa.Table) -> pa.Table:
        table = G.sorted_docs(table)
        x = lines_of(table, near_words)
        pick = np.flatnonzero(firsts(x.whole))
        pick = pick[np.argsort(bucket_of(x.whole[pick]), kind="stable")]
        doc = G.ids_of(table)[x.doc[pick]]
        return G.packed(bucket_of(x.whole[pick]), table[G.GROUP][0].as_py() if len(table) else 0, x.whole[pick], lambda i, j: G.squeeze(doc[i:j]))

    def earliest(table: pa.Table) -> pa.Table:
        h = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        doc = np.concatenate([G.unsqueeze(x) for x in table["extra"].to_pylist()])
        group, h = np.repeat(table[G.GROUP].to_numpy(), [len(x) for x in h]), np.concatenate(h)
        order = np.argsort(h)
        at, n = G.runs(h[order])
        lost = doc[order] > np.repeat(np.minimum.reduceat(doc[order], at), n)
        return answers_of(group[order][lost], h[order][lost])

    def answers_of(group: np.ndarray, h: np.ndarray) -> pa.Table:
        order = np.argsort(group, kind="stable")
        at, n = G.runs(group[order])
        return pa.table({G.GROUP: pa.array(group[order][at].astype(np.int32), pa.int32()), "kind": pa.array(np.zeros(len(at)), pa.int32()), G.BUCKET: pa.array(np.zeros(len(at)), pa.int32()), "hashes": pa.array([h[order][i : i + k].tobytes() for i, k in zip(at, n)], pa.binary())})

    def leaders(x: Lines, answers: pa.Table) -> np.ndarray:
        """Lines that no equal line precedes anywhere."""
        whole = [np.frombuffer(h, np.uint64) for k, h in zip(answers["kind"].to_pylist(), answers["hashes"].to_pylist()) if k == 0]
        lost = np.sort(np.concatenate(whole)) if whole else np.zeros(0, np.uint64)
        return firsts(x.whole) & ~G.member(x.whole, lost)

    def neighbourhood(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return G.empty(G.PACKED)
        x = lines_of(G.sorted_docs(table), near_words)
        led = leaders(x, answers)
        keys = G.short_key(np.concatenate([x.whole[led & x.near], x.variant[led[x.line]]]), lay.buckets)
        return G.presence(keys, np.zeros(len(keys), bool), table[G.GROUP][0].as_py())

    def join(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table) or not len(answers):
            return G.empty(G.PACKED)
        table, hits = G.sorted_docs(table), G.keys_in(answers.filter(pa.array([k == 1 for k in answers["kind"].to_pylist()], pa.bool_())))
        x = lines_of(table, near_words)
        led = leaders(x, answers)
        a = np.flatnonzero(led & x.near & G.member(G.short_key(x.whole, lay.buckets), hits))
        b = np.flatnonzero(led[x.line] & G.member(G.short_key(x.variant, lay.buckets), hits))
        key = np.concatenate([x.whole[a], x.variant[b], x.typed[b]])
        role = np.repeat([FULL, SHORTER, REPLACED], [len(a), len(b), len(b)])
        line = np.concatenate([a, x.line[b], x.line[b]])
        if not len(key):
            return G.empty(G.PACKED)
        order = np.lexsort((line, role, key))
        key, role, line = key[order], role[order], line[order]
        late = precedes(key, role, line)
        lost = np.zeros(len(x.whole), bool)
        lost[line[late]] = True
        fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (role[1:] != role[:-1])])
        send = fresh | ~lost[line]
        key, role, line = key[send], role[send], line[send]
        order = np.argsort(bucket_of(key), kind="stable")
        key, role, line = key[order], role[order], line[order]
        group, doc, own = answers[G.GROUP][0].as_py(), G.ids_of(table)[x.doc[line]], x.whole[line]
        entries = G.packed(bucket_of(key), group, key, lambda i, j: b"".join([role[i:j].astype(np.uint8).tobytes(), doc[i:j].tobytes(), own[i:j].tobytes()]))
        local = pa.table({G.BUCKET: pa.array([group % lay.buckets], pa.int32()), G.GROUP: pa.array([group], pa.int32()), "hashes": pa.array([x.whole[lost].tobytes()], pa.binary()), "extra": pa.array([b""], pa.binary())})
        return pa.concat_tables([entries, local])

    def precedes(key: np.ndarray, role: np.ndarray, when: np.ndarray) -> np.ndarray:
        """For entries sorted by key: whether a near entry of the key is earlier."""
        at, n = G.runs(key)
        never = np.iinfo(np.int64).max
        least = [np.repeat(np.minimum.reduceat(np.where(role == r, when, never), at), n) for r in (FULL, SHORTER, REPLACED)]
        near = np.where(role == FULL, np.minimum(least[FULL], least[SHORTER]), np.where(role == SHORTER, least[FULL], least[REPLACED]))
        return near < when

    def decide(table: pa.Table) -> pa.Table:
        rows = list(zip(table[G.GROUP].to_pylist(), table["hashes"].to_pylist(), table["extra"].to_pylist()))
        group, gone = [np.full(len(h) // 8, g) for g, h, x in rows if not x], [np.frombuffer(h, np.uint64) for _, h, x in rows if not x]
        rows = [(g, np.frombuffer(h, np.uint64), x) for g, h, x in rows if x]
        if rows:
            key = np.concatenate([h for _, h, _ in rows])
            role = np.concatenate([np.frombuffer(x, np.uint8, len(h)) for _, h, x in rows])
            doc = np.concatenate([np.frombuffer(x, np.int64, len(h), len(h)) for _, h, x in rows])
            own = np.concatenate([np.frombuffer(x, np.uint64, len(h), 9 * len(h)) for _, h, x in rows])
            of = np.repeat([g for g, _, _ in rows], [len(h) for _, h, _ in rows])
            order = np.argsort(key)
            late = precedes(key[order], role[order], doc[order])
            group.append(of[order][late])
            gone.append(own[order][late])
        return answers_of(np.concatenate(group).astype(np.int64), np.concatenate(gone))

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = G.sorted_docs(table)
        x = lines_of(table, near_words)
        stay = leaders(x, answers)
        texts, n_lines, n_removed, kept = table["text"].to_pylist(), [], [], []
        gone = ~stay
        at = np.searchsorted(x.doc[gone], np.arange(len(texts) + 1))
        numbers = x.number[gone]
        for text, i, j in zip(texts, at[:-1].tolist(), at[1:].tolist()):
            n_lines.append(text.count("\n") + 1 if text else 0)
            n_removed.append(j - i)
            if j > i:
                out = np.ones(n_lines[-1], bool)
                out[numbers[i:j]] = False
                text = "\n".join(itertools.compress(text.split("\n"), out))
            kept.append(text or "")
        new = {"doc_id": table["doc_id"], "n_lines": pa.array(n_lines, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_text": pa.array(kept, pa.string())}
        return pa.table(new | {c: table[f"__kept_{c}"] for c in keep})

    reply = f"{G.GROUP} int, kind int, {G.BUCKET} int, hashes binary"
    equal = plain.groupBy(G.GROUP).applyInArrow(wholes, G.PACKED).groupBy(G.BUCKET).applyInArrow(earliest, reply)
    emitted = plain.groupBy(G.GROUP).cogroup(equal.groupBy(G.GROUP)).applyInArrow(neighbourhood, G.PACKED)
    hits = G.shared(emitted, need_mark=False).select(G.GROUP, F.lit(1).alias("kind"), G.BUCKET, "hashes")
    entries = plain.groupBy(G.GROUP).cogroup(equal.union(hits).groupBy(G.GROUP)).applyInArrow(join, G.PACKED)
    near = entries.groupBy(G.BUCKET).applyInArrow(decide, reply)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = "doc_id bigint, n_lines bigint, n_removed bigint, kept_text string" + "".join(f", `{c}` {kinds[c]}" for c in keep)
    return dealt.groupBy(G.GROUP).cogroup(equal.union(near).groupBy(G.GROUP)).applyInArrow(cut, schema)


def query(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
