"""Token counts of whole texts for SentencePiece models, huge texts in overlapping chunks.

A boundary between a character that is no space mark and a space mark is proven
stable if no piece of the model holds a space mark after another character: then
no merge can cross it, whatever the context. The proof is made over the model's
vocabulary when it is loaded.

A text of more than ``chunk_chars`` is encoded by the library in chunks that overlap,
with the offset of every token. Neighbouring chunks are spliced at a position in
the overlap where both encodings begin a token and the boundary is stable: before
it the first chunk's tokens are those of the whole text, after it the second's,
so what the cut edges spoil is thrown away. Where the two do not agree at any such
position the overlap is widened, and at last the first chunk is lengthened, up to
the whole text (a text without spaces). Texts that fit a chunk are one chunk.

Semantics: null counts as empty (0 bytes, 0 tokens). Rows are counted one by one,
so repeated rows, ties and extra columns don't matter.
"""

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKS = " \u2581"  #: the library writes a space as the second of these


class PieceCounter:
    """Counts of one model."""

    def __init__(self, model_file: str, chunk_chars: int = 1 << 14, overlap: int = 256):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.chunk, self.overlap = chunk_chars, overlap
        pieces = (self.model.id_to_piece(i) for i in range(self.model.vocab_size()))
        self.stable = not any(MARKS[1] in p.lstrip(MARKS[1]) for p in pieces)

    def count(self, texts: list[str]) -> list[int]:
        whole = [t for t in texts if len(t) <= self.chunk or not self.stable]
        counts = iter(self.model.encode(whole, num_threads=1)) if whole else iter(())
        return [len(next(counts)) if len(t) <= self.chunk or not self.stable else self.spliced(t) for t in texts]

    def begins(self, text: str, start: int, end: int) -> np.ndarray:
        """Where the tokens of a chunk begin in the text, in order."""
        offsets = self.model.encode_as_offset_mapping(text[start:end])["offsets"]
        return np.array([a for a, _ in offsets], np.int64) + start

    def meeting(self, text: str, first: np.ndarray, second: np.ndarray, begin: int, end: int) -> int | None:
        """The last stable boundary inside the overlap at which both chunks begin a token."""
        both = np.intersect1d(first[(first > begin) & (first < end)], second[(second > begin) & (second < end)])
        return next((p for p in both[::-1].tolist() if text[p] in MARKS and text[p - 1] not in MARKS), None)

    def spliced(self, text: str) -> int:
        total, taken, start, end = 0, 0, 0, min(len(text), self.chunk)
        first = self.begins(text, start, end)
        while end < len(text):
            overlap, at = self.overlap, None
            while at is None:
                begin = max(taken, end - overlap)
                until = min(len(text), begin + max(self.chunk, 2 * overlap))
                second = self.begins(text, begin, until)
                at = self.meeting(text, first, second, begin, end)
                if begin == taken:
                    break
                overlap *= 2
            if at is None:  # no stable boundary in all of the first chunk that is not counted yet
                end = min(len(text), end + (end - start))
                first = self.begins(text, start, end)
            else:
                total += int(np.searchsorted(first, at) - np.searchsorted(first, taken))
                first, start, end, taken = second, begin, until, at
        return total + int(len(first) - np.searchsorted(first, taken))


class LibraryCounter:
    """Counts by the tokenizers library, for models of its format."""

    def __init__(self, model_file: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(model_file)
        self.model.no_truncation()
        self.model.no_padding()

    def count(self, texts: list[str]) -> list[int]:
        return [len(x.ids) for x in self.model.encode_batch(texts, add_special_tokens=False)]


_loaded: dict[str, object] = {}


def counter(model_file: str):
    if model_file not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _loaded[model_file] = LibraryCounter(model_file) if model_file.endswith(".json") else PieceCounter(model_file)
    return _loaded[model_file]


def portions(batch: pa.RecordBatch, text_col: str, most: int = 1 << 20):
    """Texts of a batch (null as empty), about a million characters at a time."""
    part, size = [], 0
    for t in batch.column(text_col):
        t = t.as_py() or ""
        part.append(t)
        size += len(t)
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096) -> DataFrame:
    """Columns: doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens)."""

    def count(batches):
        own = counter(model_file)
        for batch in batches:
            n = [x for part in portions(batch, "text") for x in own.count(part)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
