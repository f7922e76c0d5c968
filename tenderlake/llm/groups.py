"""Documents in hashed groups, and hashes exchanged between those groups.

Three operators look for content that also occurs elsewhere. They share one
plan: documents are dealt once by a hash of their id into groups of a few MB
(``grouped``; later uses of the same frame reuse that shuffle), each group sends
its distinct hashes packed by bucket (``pack``), one task per bucket finds what
several groups hold, and the answer goes back by group. A group sends each hash
once, however often it occurs there, so a passage that a third of all documents
hold costs one entry per group and no pair of documents is ever formed.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm import words

GROUP, BUCKET = "__group", "__bucket"
NO_ID = np.iinfo(np.int64).min  #: stands for a null id, which sorts first

PACKED = f"{BUCKET} int, {GROUP} int, hashes binary, extra binary"


@dataclass(frozen=True)
class Layout:
    """How many groups and buckets; both follow the bytes of text."""

    groups: int
    buckets: int


def layout(docs: DataFrame, text: str, group_bytes: int = 8 << 20, bucket_bytes: int = 24 << 20) -> Layout:
    total = docs.select(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return Layout(max(least, -(-total // group_bytes)), max(least, -(-total // bucket_bytes)))


def grouped(docs: DataFrame, lay: Layout, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns: group, doc_id, text and those to keep. Rows of one id are in one group."""
    key = F.col(f"`{id_col}`").cast("long")
    return docs.select(
        F.pmod(F.xxhash64(key), F.lit(lay.groups)).cast("int").alias(GROUP),
        key.alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        *[F.col(f"`{c}`").alias(f"__kept_{c}") for c in keep],
    )


def sorted_docs(table: pa.Table) -> pa.Table:
    """By id (null first), then text, then position: the order in which 'earlier' is meant."""
    return table.take(pc.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start"))


def ids_of(table: pa.Table) -> np.ndarray:
    return table["doc_id"].fill_null(int(NO_ID)).to_numpy()


def squeeze(values: np.ndarray) -> bytes:
    """Delta coding and zstd, for ids that rise slowly."""
    return zstandard.ZstdCompressor(level=1).compress(np.diff(values, prepend=values.dtype.type(0)).tobytes())


def unsqueeze(data: bytes, dtype=np.int64) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype), dtype=dtype)


def short_key(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the high half, 32 bits of the hash in the low half."""
    return ((h >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs in sorted keys."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return starts, np.diff(np.append(starts, len(keys)))


def spans(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of spans of n, one span after the other."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


def packed(buckets: np.ndarray, group: int, values: np.ndarray, extra) -> pa.Table:
    """One row per bucket; ``buckets`` is sorted, ``extra(lo, hi)`` gives bytes that go with values[lo:hi]."""
    at, n = runs(buckets)
    return pa.table(
        {
            BUCKET: pa.array(buckets[at].astype(np.int32), pa.int32()),
            GROUP: pa.array(np.full(len(at), group, np.int32), pa.int32()),
            "hashes": pa.array([values[i : i + k].tobytes() for i, k in zip(at, n)], pa.binary()),
            "extra": pa.array([extra(i, i + k) for i, k in zip(at, n)], pa.binary()),
        }
    )


def presence(keys: np.ndarray, marked: np.ndarray, group: int) -> pa.Table:
    """Distinct short keys of one group; for each whether it occurs again there and whether an occurrence is marked."""
    both = np.sort((keys & np.uint64(0xFFFFFFFF)) << np.uint64(1) | marked.astype(np.uint64) | (keys >> np.uint64(32)) << np.uint64(33))
    at, n = runs(both >> np.uint64(1))
    last = both[at + n - 1]  # the marked one, if any, is last
    again, mark = n > 1, (last & np.uint64(1)).astype(bool)
    key = last >> np.uint64(1)
    low = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return packed((key >> np.uint64(32)).astype(np.int64), group, low, lambda i, j: np.packbits(np.concatenate([again[i:j], mark[i:j]])).tobytes())


def shared(packs: DataFrame, need_mark: bool) -> DataFrame:
    """Per group and bucket, the short keys that occur at two places at least (and are marked at one, if asked)."""

    def meet(table: pa.Table) -> pa.Table:
        bucket = table[BUCKET][0].as_py()
        groups = table[GROUP].to_numpy()
        lows = [np.frombuffer(x, np.uint32) for x in table["hashes"].to_pylist()]
        flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=2 * len(h)) for x, h in zip(table["extra"].to_pylist(), lows)]
        size = np.array([len(h) for h in lows])
        low = np.concatenate(lows)
        again = np.concatenate([f[: len(h)] for f, h in zip(flags, lows)]).astype(bool)
        mark = np.concatenate([f[len(h) :] for f, h in zip(flags, lows)]).astype(bool)
        order = np.argsort(low, kind="stable")
        at, n = runs(low[order])
        hit = (n > 1) | np.logical_or.reduceat(again[order], at)
        if need_mark:
            hit &= np.logical_or.reduceat(mark[order], at)
        is_hit = np.zeros(len(low), bool)
        is_hit[order] = np.repeat(hit, n)
        ends = np.cumsum(size)
        out = [(int(g), low[e - k : e][is_hit[e - k : e]]) for g, e, k in zip(groups, ends, size)]
        out = [(g, x.tobytes()) for g, x in out if len(x)]
        return pa.table({GROUP: pa.array([g for g, _ in out], pa.int32()), BUCKET: pa.array([bucket] * len(out), pa.int32()), "hashes": pa.array([x for _, x in out], pa.binary())})

    return packs.groupBy(BUCKET).applyInArrow(meet, f"{GROUP} int, {BUCKET} int, hashes binary")


def keys_in(table: pa.Table) -> np.ndarray:
    """Sorted short keys of the answers for one group."""
    parts = [np.frombuffer(x, np.uint32).astype(np.uint64) | np.uint64(b) << np.uint64(32) for b, x in zip(table[BUCKET].to_pylist(), table["hashes"].to_pylist())]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array."""
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def empty(schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.table({n: pa.array([], kinds[k]) for n, k in fields})


def text_slices(table: pa.Table, lower: bool = False):
    """Words of a group's sorted documents, a few MB at a time: (first document, Words)."""
    data, offsets = words.utf8(table["text"])
    for i, j in words.slices(offsets):
        yield i, words.words_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], lower)
