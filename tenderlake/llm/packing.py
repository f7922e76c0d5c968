"""Packing of tokenised documents into windows by Karmarkar-Karp multiway differencing.

A document's ids are cut into full windows and a rest, the rest into pieces of
``piece`` ids at most. Only piece descriptions (no texts, no ids) are shuffled:
they are dealt by a hash into groups of some hundred windows, and each group's
pieces are partitioned by differencing: the two partial partitions with the
largest imbalance are merged so that large windows of one meet small windows of
the other, until one partition is left. The number of windows starts at the least
possible and rises whenever the fullest window exceeds the capacity.

Semantics: null text counts as empty and has the end id alone. Repeated rows and
ids are packed as documents of their own. Extra columns are ignored.
"""

import heapq
import itertools
import json
import os
import struct
import zlib

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm import groups as G
from tenderlake.llm.bpe_transducer import byte_symbols
from tenderlake.llm.token_counts import portions

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class WordEncoder:
    """Ids of texts for tokenizers that drop white space: every word between ASCII white space has ids of its own.

    Equal words have equal ids, so each is encoded once per worker while a bounded
    memory holds it. Printable words of letters below U+0250, on which the
    tokenizer's normaliser only lower-cases, are split by its pattern and their
    parts go to its merge model; all others go through the library whole.
    """

    def __init__(self, model_file: str, memory: int = 900_000):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(model_file)
        self.library.no_truncation()
        self.library.no_padding()
        self.memory, self.known, self.parts = memory, _Known(self), {}
        probe = self.whole(["a b\n c\t d"])[0]
        if probe != b"".join(self.whole([*"abcd"])):
            raise ValueError("this tokenizer does not drop white space")
        with open(model_file, encoding="utf-8") as f:
            spec = json.load(f)
        steps = {x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])}
        splits = [x for x in (spec["pre_tokenizer"] or {}).get("pretokenizers", []) if x["type"] == "Split"]
        self.simple = steps == {"NFC", "Replace", "Lowercase"} and len(splits) == 1 and splits[0]["invert"]
        self.pattern = regex.compile(splits[0]["pattern"]["Regex"]) if self.simple else None
        symbol = {b: c for c, b in byte_symbols().items()}
        self.symbols = {c: "".join(symbol[b] for b in chr(c).encode()) for c in range(128, 0x250)}

    @staticmethod
    def packed(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def whole(self, words: list[str]) -> list[bytes]:
        return [self.packed(x.ids) for x in self.library.encode_batch_fast(words, add_special_tokens=False)]

    def part(self, token: str) -> bytes:
        found = self.parts.get(token)
        if found is None:
            found = self.parts[token] = self.packed([t.id for t in self.library.model.tokenize(token if token.isascii() else token.translate(self.symbols))])
        return found

    def word(self, word: bytes) -> bytes:
        text = word.decode()
        if self.simple and text.isprintable() and max(text) < "\u0250" and "\u0130" not in text and "<|" not in text:
            return b"".join([self.part(t) for t in self.pattern.findall(text.lower())])
        return self.whole([text])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit numbers."""
        if len(self.known) + len(self.parts) > self.memory:
            self.known, self.parts = _Known(self), {}
        get = self.known.__getitem__
        return [b"".join(map(get, t.encode().split())) for t in texts]


class _Known(dict):
    """Ids of known words; unknown ones are encoded when asked for."""

    def __init__(self, own: WordEncoder):
        super().__init__()
        self.own = own

    def __missing__(self, word: bytes) -> bytes:
        found = self[word] = self.own.word(word)
        return found


_loaded: dict[str, WordEncoder] = {}


def encoder(model_file: str) -> WordEncoder:
    """One for each worker: tasks that follow find what it knows."""
    if model_file not in _loaded:
        _loaded[model_file] = WordEncoder(model_file)
    return _loaded[model_file]


def cut(doc_ids: int, capacity: int, piece: int):
    """(start, length) of the pieces of a document: full windows, then pieces of the rest."""
    full = doc_ids - doc_ids % capacity
    for start in range(0, full, capacity):
        yield start, capacity
    for start in range(full, doc_ids, piece):
        yield start, min(piece, doc_ids - start)


def differencing(lengths: list[int], windows: int) -> list[list[int]]:
    """Items by window: Karmarkar-Karp partition into the given number of windows.

    A partial partition holds its non-empty windows only, largest first, as
    (sums, items); the others are empty.
    """
    count = itertools.count()
    heap = [(-n, next(count), [n], [[i]]) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a, a_items = heapq.heappop(heap)
        _, _, b, b_items = heapq.heappop(heap)
        over = len(a) + len(b) - windows  # so many of a's smallest meet b's smallest, crosswise
        sums, items = list(a), list(a_items)
        if over > 0:
            for k in range(over):
                i, j = len(a) - over + k, len(b) - 1 - k
                # a is in falling order and meets b in rising order
                sums[i] += b[j]
                items[i] = items[i] + b_items[j]
            sums += b[: len(b) - over]
            items += b_items[: len(b) - over]
        else:
            sums += b
            items += b_items
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums, items = [sums[i] for i in order], [items[i] for i in order]
        least = sums[-1] if len(sums) == windows else 0
        heapq.heappush(heap, (least - sums[0], next(count), sums, items))
    return heap[0][3] if heap else []


def fill(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items by window; the window count rises from the least possible until no window exceeds the capacity."""
    windows = -(-sum(lengths) // capacity)
    while lengths:
        parts = differencing(lengths, windows)
        if all(sum(lengths[i] for i in p) <= capacity for p in parts):
            return parts
        windows += max(1, windows // 500)
    return []


def pack(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, capacity: int = 2048, piece: int = 512) -> DataFrame:
    """Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; a row for each piece."""
    lay = G.layout(docs, text_col, group_bytes=2 << 20)
    end = WordEncoder.packed([end_id])

    def encode(batches):
        own = encoder(model_file)
        for batch in batches:
            rows, ids = [], iter(batch.column("doc_id").to_pylist())
            for part in portions(batch, "text"):
                for data, doc in zip(own.encode(part), ids):  # ids last: zip takes one more of what comes first
                    data += end
                    total = len(data) // 4
                    rows += [(doc, i, n, zlib.crc32(data[4 * i : 4 * (i + n)]), total) for i, n in cut(total, capacity, piece)]
            if not rows:
                continue
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], [x.split()[0] for x in PIECES.split(", ")])

    def place(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "start", "doc_tokens", "ids_crc32")])
        group, lengths = table[G.GROUP][0].as_py(), table["length"].to_pylist()
        full = [[i] for i, n in enumerate(lengths) if n == capacity]
        rest = [i for i, n in enumerate(lengths) if n < capacity]
        windows = full + [[rest[i] for i in sorted(w)] for w in fill([lengths[i] for i in rest], capacity)]
        sequence, offset = [0] * len(lengths), [0] * len(lengths)
        for s, items in enumerate(windows):
            at = 0
            for i in items:
                sequence[i], offset[i] = (group << 32) + s, at
                at += lengths[i]
        return table.drop_columns([G.GROUP]).append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offset, pa.int64()))

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    pieces = rows.mapInArrow(encode, PIECES)
    # full windows and rests alike are dealt by content, so rows without an id spread too
    dealt = pieces.withColumn(G.GROUP, F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(lay.groups)).cast("int"))
    return dealt.groupBy(G.GROUP).applyInArrow(place, PIECES + ", sequence_id long, offset long")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
