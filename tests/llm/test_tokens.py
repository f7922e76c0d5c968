"""Token counts, the BPE transducer and packing, against the libraries on whole texts."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tenderlake.llm import bpe_transducer, packing, token_counts

ALPHABET = [*"ab  \n\t'sdlvret.,!?09é的🎉 ​\x1c\x1d\x85▁́ſİßа中文ัàाأΣς"] + ["<|endoftext|>", "<|startoftext|>", "  ", "\r\n", "the", " the", "a" * 40, "﻿", "　", "\x00", " ", "I'll", " ,"]


def texts(seed, n=400):
    r = random.Random(seed)
    made = ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 60))) for _ in range(n)]
    return made + [None, "", " ", "a" * 3000, "ab" * 2000, " " * 300, "\n" * 200, "x" * 700 + " y", "word " * 9000, "<|endoftext|>" * 3, made[0]]


def frame(spark, values):
    return spark.createDataFrame([(i if i % 50 else None, t, "clash", 7) for i, t in enumerate(values)], "doc_id long, text string, n_tokens string, ids string").repartition(3)


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.no_truncation()
    t.no_padding()
    return t


def test_counts_of_pieces(spark):
    values = texts(1)
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = token_counts.count_tokens(frame(spark, values), public_tokenizers.path("piece_bpe_32k.model"), limit=500)
    expected = sorted((len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 500) for t in values)
    assert sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()) == expected


@pytest.mark.parametrize("chunk, overlap", [(50, 8), (64, 1), (200, 199)])
def test_splicing(chunk, overlap):
    own = token_counts.PieceCounter(public_tokenizers.path("piece_bpe_32k.model"), chunk_chars=chunk, overlap=overlap)
    values = [t or "" for t in texts(2)]
    assert own.stable
    assert own.count(values) == [len(x) for x in own.model.encode(values)]


def test_chunk_edges_are_thrown_away(monkeypatch):
    """Chunks cut inside words have tokens that the whole text has not; long runs without spaces widen the overlap."""
    own = token_counts.PieceCounter(public_tokenizers.path("piece_bpe_32k.model"), chunk_chars=97, overlap=16)
    r = random.Random(8)
    text = " ".join("".join(r.choice("abcdefgh") for _ in range(r.choice([3, 9, 14, 60, 130]))) for _ in range(300))
    right = len(own.model.encode(text))
    chunks = []
    plain = own.begins
    monkeypatch.setattr(own, "begins", lambda t, a, b: chunks.append((a, b)) or plain(t, a, b))
    assert own.spliced(text) == right
    assert sum(len(own.model.encode(text[i : i + 97])) for i in range(0, len(text), 97)) != right
    assert len(chunks) > len(text) / 120 and max(b - a for a, b in chunks) > 97 > min(b - a for a, b in chunks)
    assert own.spliced("z" * 1000) == len(own.model.encode("z" * 1000))


def test_counts_by_the_other_library(spark):
    values = texts(3, 50)
    got = token_counts.count_tokens(frame(spark, values), public_tokenizers.path("byte_bpe_50k.json"))
    expected = sorted(len(library("byte_bpe_50k.json").encode(t or "", add_special_tokens=False).ids) for t in values)
    assert sorted(r.n_tokens for r in got.collect()) == expected


def test_round_trip(spark):
    values, lib = texts(4), library("byte_bpe_50k.json")
    got = bpe_transducer.round_trip(frame(spark, values), public_tokenizers.path("byte_bpe_50k.json"), texts=True)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = []
    for t in values:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        joined, decoded = ",".join(map(str, ids)), lib.decode(ids, skip_special_tokens=False)
        expected.append((len(ids), sha(joined), sha(decoded), joined, decoded))
    assert sorted(tuple(r)[1:] for r in got.collect()) == sorted(expected)


def odd_pretoken(r):
    kinds = ["ab", "the", "ing", "z", "é", "aaaa", "tion", "----", "=", "x" * 70, "thethe", "日本"]
    return "".join(r.choice(kinds) * r.randint(1, 20) for _ in range(r.randint(1, 80)))


def test_every_token_comes_from_the_stream(spark, sf_dir, monkeypatch):
    own, lib = bpe_transducer.Transducer(public_tokenizers.path("byte_bpe_50k.json")), library("byte_bpe_50k.json")
    own.runs.known.longest = own.runs.spaced.longest = -1  # nothing is remembered
    emitted = []
    for name in ("feed", "end"):
        plain = getattr(bpe_transducer.Stream, name)
        monkeypatch.setattr(bpe_transducer.Stream, name, lambda self, *a, plain=plain: emitted.append(plain(self, *a)) or emitted[-1])
    values = [r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").limit(40).collect()] + [t or "" for t in texts(9, 20)]
    values = [t.replace("\n", " ") for t in values]  # the line feed's own token is looked up once for a text
    special = 0
    for text in values:
        want = lib.encode(text, add_special_tokens=False).ids
        assert own.digest(text)[0] == len(want) and own.ids(text) == want
        special += sum(i == 50256 for i in want)
    n = sum(len(lib.encode(t, add_special_tokens=False).ids) for t in values)
    emitted.clear()
    assert sum(own.digest(t)[0] for t in values) == n and sum(map(len, emitted)) == n - special


def test_the_window_of_a_long_pretoken_is_bounded():
    own, lib = bpe_transducer.Transducer(public_tokenizers.path("byte_bpe_50k.json")), library("byte_bpe_50k.json")
    r, most = random.Random(5), 2 * (own.lookahead + own.longest)
    for _ in range(40):
        text = odd_pretoken(r)
        stream, out = bpe_transducer.Stream(own), []
        for byte in text.encode():
            out += stream.feed(bytes([byte]))
            assert len(stream.token) < most
        pieces = bpe_transducer.pretokens(text)
        assert [t for p in pieces for t in own.pretoken(p.encode())] == lib.encode(text, add_special_tokens=False).ids
        if len(pieces) == 1:
            assert out + stream.end() == lib.encode(text, add_special_tokens=False).ids


def test_lookahead_decides_tokens():
    """Tokens that end ``lookahead`` bytes before the last byte read are those of the whole pretoken."""
    own, lib = bpe_transducer.Transducer(public_tokenizers.path("byte_bpe_50k.json")), library("byte_bpe_50k.json")
    r = random.Random(6)
    for _ in range(60):
        text = "".join(r.choice(["the", "ing", "a", "aa", "tion", "er", "s", "ss", "zz"]) for _ in range(300))
        whole = lib.encode(text).ids
        for cut in r.sample(range(own.lookahead, len(text)), 5):
            at = 0
            for mine, its in zip(lib.encode(text[:cut]).ids, whole):
                at += len(own.bytes_of[mine])
                if at > cut - own.lookahead:
                    break
                assert mine == its


def test_lookahead_of_a_small_list(tmp_path):
    """In 'ab', 'bc', 'cd' (made in the reverse order) every merge waits for the next one."""
    import json

    from tenderlake.llm.merges import MergeList

    vocabulary = {c: i for i, c in enumerate(["a", "b", "c", "d", "cd", "bc", "ab"])}
    (tmp_path / "m.json").write_text(json.dumps({"added_tokens": [], "model": {"vocab": vocabulary, "merges": ["c d", "b c", "a b"]}}))
    own = MergeList(str(tmp_path / "m.json"))
    assert own.lookahead() == 3 and not own.follows(vocabulary["a"], vocabulary["b"]) and own.follows(vocabulary["ab"], vocabulary["cd"])


def test_memory_is_bounded():
    own = bpe_transducer.Transducer(public_tokenizers.path("byte_bpe_50k.json"), memory=20_000)
    own.pairs_held = 30
    for i in range(200):
        own.digest(f"w{i} x{i} y{i}")
    assert own.runs.known.held <= 5_000 and own.runs.spaced.held <= 15_000 and len(own.pairs) <= 31


def test_long_texts_pass_in_blocks(monkeypatch):
    own, lib = bpe_transducer.Transducer(public_tokenizers.path("byte_bpe_50k.json")), library("byte_bpe_50k.json")
    plain = bpe_transducer.blocks
    monkeypatch.setattr(bpe_transducer, "blocks", lambda text: plain(text, 50))
    r = random.Random(7)
    for _ in range(30):
        text = "".join(r.choice(["word", " ", "  ", "\n", "é", "<|endoftext|>", "12", "!?", " x"]) for _ in range(200))
        assert own.ids(text) == lib.encode(text, add_special_tokens=False).ids and "".join(plain(text, 50)) == text


def test_decoding_broken_bytes():
    own, lib = bpe_transducer.transducer(public_tokenizers.path("byte_bpe_50k.json")), library("byte_bpe_50k.json")
    r = random.Random(6)
    for _ in range(200):
        ids = [r.randrange(50257) for _ in range(r.randint(0, 12))]
        assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_packing(spark):
    values, lib = texts(7), library("word_bpe_49k.json")
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(values)], "doc_id long, text string, sequence_id string, __group int")
    rows = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=256, piece=64).collect()
    ids = {i: lib.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(values)}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    for spans, limit in [(by_doc, None), (by_sequence, 256)]:
        for key, parts in spans.items():
            at = 0
            for start, length in sorted(parts):
                assert start == at
                at += length
            assert at == len(ids[key]) if limit is None else at <= limit
    assert set(by_doc) == set(ids)
    assert len(by_sequence) <= sum(map(len, ids.values())) / 256 * 1.05 + 4


def test_packing_of_a_batch_that_is_encoded_in_portions(spark):
    lib, values = library("word_bpe_49k.json"), [f"{i} lot " * (70_000 + i) for i in range(8)] + ["tail"]
    docs = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").coalesce(1)
    rows = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "doc_tokens").distinct().collect()
    assert sorted(map(tuple, rows)) == [(i, len(lib.encode(t, add_special_tokens=False).ids) + 1) for i, t in enumerate(values)]


def test_differencing_is_even():
    r = random.Random(8)
    lengths = [r.randint(1, 500) for _ in range(400)]
    parts = packing.differencing(lengths, 30)
    sums = [sum(lengths[i] for i in p) for p in parts]
    assert sorted(i for p in parts for i in p) == list(range(400)) and max(sums) - min(sums) <= 2
    assert packing.fill([], 10) == []
    assert all(sum([10, 10, 1][i] for i in w) <= 10 for w in packing.fill([10, 10, 1], 10))


def test_empty_tables(spark):
    none = frame(spark, []).select("*")
    assert token_counts.count_tokens(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert bpe_transducer.round_trip(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert packing.pack(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_queries_return_every_document(spark, sf_dir):
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert token_counts.query(spark, sf_dir).agg(F.count_distinct("doc_id")).first()[0] == n
    assert bpe_transducer.query(spark, sf_dir).agg(F.count_distinct("doc_id")).first()[0] == n
    assert packing.query(spark, sf_dir).agg(F.count_distinct("doc_id")).first()[0] == n
