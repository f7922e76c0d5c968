"""Best-fit packing by minimum bin slack: documents whole, windows as full as the lengths at hand allow.

A document is one piece; only one longer than a window is cut, into full windows
with the rest in front. Piece descriptions (no texts, no ids) are dealt by a hash
into large groups. In a group every window starts with the longest piece left, and
a subset-sum over the lengths still available, one bit for each reachable sum,
finds the fullest combination for the rest of the window; its pieces are removed.
What a group leaves in its emptiest windows is packed again over 64 groups together,
so that the last windows of the groups don't add up.

Semantics: null text counts as empty and has the end id alone. Repeated rows and
ids are packed as documents of their own. Texts of any length are encoded whole. An empty table gives an empty result. Extra columns are ignored.
"""

import bisect
import os
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm import groups as G
from tenderlake.llm.merges import MergeList
from tenderlake.llm.runs import PATTERN
from tenderlake.llm.storage import checkpointed
from tenderlake.llm.token_counts import portions

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
MERGED = 64  #: groups whose emptiest windows are packed again together
OPENED = 32  #: windows that a group opens again at most
BLANKS = re.compile(r"\s{2048}")


class ByteEncoder:
    """Ids of texts, as the library gives them, from the vocabulary's ranks.

    Encoding by ranks is several times as fast. Its tokens are the library's if all
    neighbours inside a pretoken can stand side by side (``merges``), which is looked up
    for the pairs of a text together; a text that has another pair, or a word so long that
    ranks are slow, or white space so long that their pattern fails, or a file with other
    settings goes to the library itself.
    """

    LONG = 2048  #: characters of a word
    PAIRS = 1 << 20  #: pairs held

    def __init__(self, model_file: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(model_file)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.merges, self.ranks, self.good = MergeList(model_file), None, np.zeros(0, np.int64)
        tokens = self.merges.reached()
        self.n = 1 + max(self.merges.bytes_of)
        self.size, self.before, self.behind = np.zeros(self.n, np.int64), np.zeros(self.n, bool), np.zeros(self.n, bool)
        for data, i in tokens.items():  # bytes, and whether a token begins, or ends, with a space
            self.size[i], self.before[i], self.behind[i] = len(data), data[0] == 0x20, data[-1:].isspace()
        if self.library.normalizer is None and [tokens[x] for x in sorted(tokens, key=lambda x: self.merges.order(tokens[x]))] == sorted(tokens.values()):
            import tiktoken

            self.ranks = tiktoken.Encoding("ranks", pat_str=PATTERN.pattern, mergeable_ranks=tokens, special_tokens={})

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out, ranked = [], []
        for k, text in enumerate(texts):
            if any(map(text.__contains__, self.special)):
                parts = self.splitter.split(text)
                found = iter(self.encode(parts[::2]))
                out.append(np.concatenate([np.array([self.special[p]], np.uint32) if i % 2 else next(found) for i, p in enumerate(parts)]))
            elif self.ranks is None or len(text) > self.LONG and (max(map(len, text.split(" "))) > self.LONG or BLANKS.search(text)):
                out.append(self.whole(text))
            else:
                out.append(np.array(self.ranks.encode_ordinary(text), np.uint32))
                ranked.append(k)
        for k in self.doubtful([out[k] for k in ranked]):
            k = ranked[k]
            ends = np.cumsum([len(p.encode()) for p in PATTERN.findall(texts[k])])
            at, ids = np.cumsum(self.size[out[k]])[:-1], out[k].tolist()
            inside = ~np.isin(at, ends)
            if not all(self.merges.follows(ids[i], ids[i + 1]) for i in np.flatnonzero(inside).tolist()):
                out[k] = self.whole(texts[k])
        return out

    def doubtful(self, found: list[np.ndarray]) -> list[int]:
        """Which texts have neighbours that can't stand side by side, inside a pretoken or not."""
        ids = np.concatenate([np.zeros(0, np.uint32), *found]).astype(np.int64)
        text = np.repeat(np.arange(len(found)), [len(x) for x in found])
        # a space behind another character begins a pretoken
        inner = np.flatnonzero((text[1:] == text[:-1]) & (~self.before[ids[1:]] | self.behind[ids[:-1]]))
        keys, back = np.unique(ids[inner] * self.n + ids[inner + 1], return_inverse=True)
        fine = G.member(keys, self.good)
        new = np.flatnonzero(~fine)
        fine[new] = [self.merges.side_by_side(*divmod(k, self.n)) for k in keys[new].tolist()]
        if len(new):
            self.good = np.union1d(self.good, keys[fine]) if len(self.good) < self.PAIRS else keys[fine]
        return np.unique(text[inner[~fine[back]]]).tolist()


_loaded: dict[str, ByteEncoder] = {}


def encoder(model_file: str) -> ByteEncoder:
    """One for each worker: tasks that follow find what it knows."""
    if model_file not in _loaded:
        _loaded[model_file] = ByteEncoder(model_file)
    return _loaded[model_file]


def cut(doc_ids: int, capacity: int):
    """(start, length) of the pieces of a document: one, or the rest and then full windows."""
    first = doc_ids % capacity or capacity
    yield 0, first
    for start in range(first, doc_ids, capacity):
        yield start, capacity


class Lengths:
    """The multiset of lengths still available."""

    def __init__(self, lengths: list[int]):
        self.left = Counter(lengths)
        self.rising = sorted(self.left)

    def take(self, length: int) -> None:
        self.left[length] -= 1
        if not self.left[length]:
            self.rising.pop(bisect.bisect_left(self.rising, length))

    def fullest(self, room: int) -> list[int]:
        """Lengths whose sum is the largest possible within ``room``; of equal sums one with long pieces."""
        reach, mask, trail = 1, (1 << (room + 1)) - 1, []
        for k in range(bisect.bisect_right(self.rising, room) - 1, -1, -1):
            length = self.rising[k]
            copies = min(self.left[length], room // length)
            some = 1
            while copies:  # 1, 2, 4, ... copies at a time make up every number of copies
                n = min(some, copies)
                more = (reach | reach << n * length) & mask
                if more != reach:
                    trail.append((n, length, reach))
                    reach = more
                copies, some = copies - n, 2 * some
            if reach >> room:
                break
        total, out = reach.bit_length() - 1, []
        for n, length, before in reversed(trail):
            if not before >> total & 1:
                out += [length] * n
                total -= n * length
        return out


def windows(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items by window, each window the fullest that starts with the longest item left."""
    items: dict[int, list[int]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        items.setdefault(lengths[i], []).append(i)
    left, out = Lengths(lengths), []
    while left.rising:
        longest = left.rising[-1]
        left.take(longest)
        chosen = [longest]
        if longest < capacity:
            for length in left.fullest(capacity - longest):
                left.take(length)
                chosen.append(length)
        out.append([items[n].pop() for n in chosen])
    return out


def best_fit(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 2, capacity: int = 1024, group_bytes: int = 32 << 20) -> DataFrame:
    """Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset; a row for each piece."""
    total = docs.select(F.sum(F.octet_length(F.col(f"`{text_col}`").cast("string")))).first()[0] or 0
    groups = max(1, -(-total // group_bytes))  # as few as memory allows: the more lengths at hand, the fuller the windows
    end = np.array([end_id], np.uint32)

    def encode(batches):
        own, copies = encoder(model_file), Counter()
        for batch in batches:
            rows, ids = [], iter(batch.column("doc_id").to_pylist())
            for part in portions(batch, "text"):
                for found, doc in zip(own.encode(part), ids):  # ids last: zip takes one more of what comes first
                    data = np.append(found, end).astype("<u4").tobytes()
                    for piece, (i, n) in enumerate(cut(len(data) // 4, capacity)):
                        row = (doc, piece, i, n, zlib.crc32(data[4 * i : 4 * (i + n)]))
                        # equal pieces are dealt to different groups, in whichever order a task meets them
                        rows.append((*row, copies[row]))
                        copies[row] += 1
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], [*[x.split()[0] for x in PIECES.split(", ")], "copy"])

    def placed(table: pa.Table, last: bool) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "piece", "start", "length", "ids_crc32")])
        group, lengths = table[G.GROUP][0].as_py(), table["length"].to_pylist()
        # whole windows first, then the fullest; those opened again are at the end
        found = sorted(((sum(lengths[i] for i in w), w) for w in windows(lengths, capacity)), key=lambda x: -x[0])
        closed = max(len(found) - OPENED, sum(n == capacity for n, _ in found)) if not last else len(found)
        sequence, offset, again = [0] * len(lengths), [0] * len(lengths), [False] * len(lengths)
        for s, (_, items) in enumerate(found):
            at = 0
            for i in sorted(items):
                sequence[i], offset[i], again[i] = (last << 61) + (group << 32) + s, at, s >= closed
                at += lengths[i]
        if not last:
            table = table.drop_columns(["copy"]).append_column("again", pa.array(again, pa.bool_()))
        return table.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    def pack(table: pa.Table) -> pa.Table:
        return placed(table, False)

    def pack_again(table: pa.Table) -> pa.Table:
        return placed(table, True).drop_columns([G.GROUP])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    pieces = rows.mapInArrow(encode, f"{PIECES}, copy long")
    dealt = pieces.withColumn(G.GROUP, F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "copy"), F.lit(groups)).cast("int"))
    once = checkpointed(dealt.groupBy(G.GROUP).applyInArrow(pack, f"{PIECES}, {G.GROUP} int, again boolean, sequence_id long, offset long"))
    opened = once.where("again").withColumn(G.GROUP, F.floor(F.col(G.GROUP) / MERGED).cast("int")).drop("again", "sequence_id", "offset")
    return once.where("not again").drop("again", G.GROUP).union(opened.groupBy(G.GROUP).applyInArrow(pack_again, f"{PIECES}, sequence_id long, offset long"))


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
