"""Byte-level BPE as a streaming transducer with bounded lookahead, and its decoder.

Which tokens can stand side by side follows from the merge list alone, and an
encoding is exactly a sequence of tokens in which all neighbours can (``merges``).
So every prefix of a pretoken has one last token, found from the last tokens of the
prefixes before it: the transducer (``Stream``) takes a byte, steps through an automaton of
all tokens, and notes which of the tokens that end there can stand after the last token of
the prefix before it. A token that ends ``lookahead`` bytes before the last
byte read is final, by the bound that the merge list gives, and is emitted; the state is the window
of prefixes since then. All bytes of all texts take this path, whatever their length.

Texts are split into pretokens by the tokenizer's pattern. A memory bounded in bytes keeps
what the transducer emitted for short runs of text; longer ones pass it again each time.

Ids leave in portions and are hashed at once; their bytes go through an incremental
UTF-8 state machine and the text that comes out is hashed as well, so neither the
ids nor the decoded text of a document is ever held. Broken sequences become U+FFFD.

Semantics: null counts as empty (no ids, empty text). Rows are independent, so
repeated rows, ties and extra columns don't matter, and an empty table gives an empty
result. A very long text costs the memory of the row itself and of the runs of a million
characters, or of its longest stretch without a single space.
"""

import codecs
import gc
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.merges import MergeList, byte_symbols  # noqa: F401  (others import byte_symbols from here)
from tenderlake.llm.runs import Runs, blocks, pretokens
from tenderlake.llm.token_counts import portions

class Stream:
    """The transducer at work on one pretoken: ``feed`` bytes, take tokens as they become final, ``end`` for the rest."""

    def __init__(self, own: "Transducer"):
        self.own = own
        self.start: list[int] = []  #: for every prefix of the window: where its last token begins,
        self.token: list[int] = []  #: and which it is
        self.before = -1  #: the token emitted last
        self.node = 0  #: of the automaton of tokens

    def feed(self, data: bytes) -> list[int]:
        """Take bytes; returns the tokens that have become final."""
        own, start, token, out, before = self.own, self.start, self.token, [], self.before
        step, fail, ending, shorter, size = own.step.get, own.fail, own.ending, own.shorter, own.size
        pairs, wide, most, node, end = own.pairs.get, own.wide, 2 * (own.lookahead + own.longest), self.node, len(self.token)
        for byte in data:
            end += 1
            at = step(node << 8 | byte)
            while at is None:
                node = fail[node]
                at = step(node << 8 | byte)
            node = at
            t = ending[node]  # the longest token that ends here, then shorter ones: one of them fits
            while True:
                k = end - size[t]
                if k > 0:
                    left = token[k - 1]
                    if left >= 0:
                        fits = pairs(left * wide + t)
                        if own.beside(left, t) if fits is None else fits:
                            break
                elif k == 0 and (before < 0 or own.beside(before, t)):
                    break
                t = shorter[t]
            start.append(k)
            token.append(t)
            if end >= most:
                out += self.final(end - own.lookahead)
                end, before = len(token), self.before
        self.node = node
        return out

    def final(self, until: int) -> list[int]:
        """Emit the tokens that end at ``until`` or before."""
        out, k = [], len(self.token)
        while k:
            if k <= until:
                out.append(k)
            k = self.start[k - 1]
        tokens = [self.token[k - 1] for k in reversed(out)]
        if out:
            done = out[0]
            del self.start[:done], self.token[:done]
            self.start[:] = [s - done for s in self.start]  # what begins before is of no encoding that is still open
            self.token[:] = [t if s >= 0 else -2 for s, t in zip(self.start, self.token)]
            self.before = tokens[-1]
        return tokens

    def end(self) -> list[int]:
        """The tokens of the whole window; nothing follows."""
        out, k = [], len(self.token)
        while k:
            out.append(self.token[k - 1])
            k = self.start[k - 1]
        out.reverse()
        return out


class Transducer(MergeList):
    """Encoder and decoder of one merge list."""

    def __init__(self, model_file: str, memory: int = 256 << 20):
        super().__init__(model_file)
        tokens = self.reached()
        self.longest, self.lookahead = max(map(len, tokens)), super().lookahead()
        self.wide = 1 + max(self.bytes_of)
        self.size = [0] * self.wide
        self.step: dict[int, int] = {}  #: automaton of the tokens: node and byte to node,
        self.fail = [0]  #: where to go on if there is none,
        self.ending = [-1]  #: and the longest token that ends at a node
        self.shorter = [-1] * self.wide  #: the longest token that a token ends with
        last, order = {}, [0]
        for data, token in tokens.items():
            self.size[token], node = len(data), 0
            for b in data:
                key = node << 8 | b
                if key not in self.step:
                    self.step[key] = len(self.fail)
                    self.fail.append(0)
                    self.ending.append(-1)
                    order.append(key)
                node = self.step[key]
            last[token], self.ending[node] = node, token
        depth = [0] * len(order)
        for node in range(1, len(order)):  # a node's parent has a smaller number
            depth[node] = depth[order[node] >> 8] + 1
        for node in sorted(range(1, len(order)), key=depth.__getitem__):
            parent, b = divmod(order[node], 256)
            at = self.fail[parent]
            while parent and (at << 8 | b) not in self.step and at:
                at = self.fail[at]
            self.fail[node] = self.step.get(at << 8 | b, 0) if parent else 0
            if self.ending[node] < 0:
                self.ending[node] = self.ending[self.fail[node]]
        for token, node in last.items():
            self.shorter[token] = self.ending[self.fail[node]]
        self.runs = Runs(self.run, [*self.special], memory)

    def beside(self, a: int, b: int) -> bool:
        """``side_by_side``, kept for the pairs met."""
        if len(self.pairs) >= self.pairs_held:
            self.pairs.clear()
        found = self.pairs[a * self.wide + b] = self.side_by_side(a, b)
        return found

    def pretoken(self, data: bytes) -> list[int]:
        stream = Stream(self)
        return stream.feed(data) + stream.end()

    def run(self, run: str) -> tuple[tuple[int, str, bytes], int]:
        """Number of ids, ids in decimal, and their bytes, of a run of pretokens."""
        if run in self.special:
            ids = [self.special[run]]
        else:
            parts = pretokens(run)
            if len(parts) > 1:  # each of them is remembered by itself
                found = self.runs.plain_parts(parts)
                ids = ",".join([x[1] for x in found])
                data = b"".join([x[2] for x in found])
                return (sum([x[0] for x in found]), ids, data), len(ids) + len(data) + 150
            ids = self.pretoken(run.encode())
        text, data = ",".join(map(str, ids)), b"".join(map(self.bytes_of.__getitem__, ids))
        return (len(ids), text, data), len(text) + len(data) + 150

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and SHA-256 of the ids (decimal, joined by commas) and of the decoded text."""
        n, ids, plain, machine, comma = 0, hashlib.sha256(), hashlib.sha256(), codecs.getincrementaldecoder("utf-8")("replace"), b""
        for found in map(self.runs.of, blocks(text)):
            if not found:
                continue
            n += sum([x[0] for x in found])
            ids.update(comma + ",".join([x[1] for x in found]).encode())
            plain.update(machine.decode(b"".join([x[2] for x in found])).encode())
            comma = b","
        plain.update(machine.decode(b"", True).encode())
        return n, ids.hexdigest(), plain.hexdigest()

    def ids(self, text: str) -> list[int]:
        return [int(i) for part in blocks(text) for x in self.runs.of(part) for i in x[1].split(",")]

    def decode(self, ids: list[int]) -> str:
        return "".join(self.decoded(iter(ids)))

    def decoded(self, ids: Iterator[int]) -> Iterator[str]:
        """Text of a stream of ids, as soon as its characters are complete."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for i in ids:
            if out := machine.decode(self.bytes_of[i]):
                yield out
        if out := machine.decode(b"", True):
            yield out


_loaded: dict[str, Transducer] = {}


def transducer(model_file: str) -> Transducer:
    if model_file not in _loaded:
        _loaded[model_file] = Transducer(model_file)
        gc.freeze()  # its tables stay as long as the worker
    return _loaded[model_file]


def round_trip(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", texts: bool = False) -> DataFrame:
    """Columns: doc_id, n_tokens, ids_sha256, decoded_sha256; with ``texts`` also ids (decimal, comma-joined) and decoded."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids string, decoded string" if texts else "")

    def run(batches):
        own = transducer(model_file)
        for batch in batches:
            out, kept = [], []
            for part in portions(batch, "text"):
                out += map(own.digest, part)
                if texts:
                    for text in part:
                        ids = own.ids(text)
                        kept.append((",".join(map(str, ids)), own.decode(ids)))
            kinds = (pa.int64(), pa.string(), pa.string())
            arrays = [batch.column("doc_id"), *[pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]]
            arrays += [pa.array([x[k] for x in kept], pa.string()) for k in (0, 1)] if texts else []
            yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in schema.split(", ")])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
