"""Byte-level BPE, token files and packing against the tokenizer libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from fixtures import fuzz_texts, here, odd_documents, table

from kpimill.llm.base import parts_by_bytes
from kpimill.llm.byte_bpe import StreamDecoder, Transducer, Utf8Machine, encode_decode, load_ranks, transducer_encoder
from kpimill.llm.chunks import ChunkEncoder, CompiledVocabulary, PieceEncoder, ids_of, library_encoder, split_chunks
from kpimill.llm.packing import best_fit, pack, plan_patterns
from kpimill.llm.token_files import pack_ranks, read_block, token_files, unpack_ranks, write_block

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def reference_bpe(ranks):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_chunks_concatenate():
    for t in fuzz_texts(3000):
        assert "".join(split_chunks(t)) == t


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunked_encoding_is_the_library_s(name):
    run, want = ChunkEncoder(library_encoder(public_tokenizers.path(name)), limit=50), library(name)
    for t in [*fuzz_texts(4000, 2), "a" * 5000, " " * 3000, "Hello there, general. " * 300]:
        assert ids_of(run(t)).tolist() == want(t)


def test_compiled_words_are_the_library_s():
    """Plain words skip the pattern; lower-casing may turn a letter into several characters."""
    run, want = ChunkEncoder(CompiledVocabulary(public_tokenizers.path("word_bpe_49k.json")).encoder(), limit=50), library("word_bpe_49k.json")
    for t in ["a \u0130stanbul x\u0130y \u00c9t\u00e9 e\u0301 \u00aa \u0416\u0443\u043a \u4e2d b", "it's 12 a.b \x01 c", *fuzz_texts(2000, 4)]:
        assert ids_of(run(t)).tolist() == want(t)


def test_pieces_are_the_library_s():
    """Cutting by tables of bytes gives the ids of the pattern: apostrophes, digits, marks, combining characters, blanks of all kinds."""
    parts = ["a", "B", "h", "H", "I", "1", "\u0663", "\u00bd", "_", ".", "<", "-", "'", "\u2019", "'s", "s'", "don't", "THE", "<|endoftext|>", "\u0130", "\u0131", "\u0331", "\u0307", "\u0301", "\u0338"]
    parts += [*" \n\t\x0b\x1c\x85\xa0\u2009\u3000\x00\x7f", "\u00c9", "\u00df", "\u1e9e", "\u03a3", "\u4e2d", "\u0928\u093f", "\u200d", "\U0001f600", "\ufb01", "\u00aa", "\u212a", "\ufb2c", "\u1e96"]
    rng = random.Random(3)
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(6000)] + [*fuzz_texts(2000, 6), "", None, " ", "\n"]
    plain = [t for t in texts if t is None or not any("\u0300" <= c <= "\u036f" for c in t)]  # these are made small first
    assert len(plain) > 100
    run, want = PieceEncoder(CompiledVocabulary(public_tokenizers.path("word_bpe_49k.json")).encoder(), b"\2\0\0\0", limit=500), library("word_bpe_49k.json")
    for some in (texts, plain):
        for at in range(0, len(some), 500):
            got = run(pa.array([None, *some[at : at + 500]], pa.string()).slice(1))
            assert [ids_of(b).tolist() for b in got.to_pylist()] == [[*want(t or ""), 2] for t in some[at : at + 500]]


def test_pieces_of_many_texts_are_encoded_once():
    """Words that differ in case, in the marks after them or in what a line break ties to them are merged once for all texts."""
    asked = []
    many = CompiledVocabulary(public_tokenizers.path("word_bpe_49k.json")).encoder()
    run = PieceEncoder(lambda chunks: asked.extend(chunks) or many(chunks))
    for _ in range(2):
        run(pa.array([f"x {w}{m} {w.title()}{m}\nx" for w in ("lorem", "ipsum") for m in (".", ",", "!?", "...", "")], pa.string()))
    assert sorted(asked) == sorted([" x", " x", " lorem", " ipsum", " .", " ,", " !?", " ..."])  # "x" begins a text and follows a line break


def test_parts_by_bytes_hold_every_row():
    texts = ["a" * 10, None, "b" * 100, "", "c" * 5, "\u00e9" * 3, None]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    for most in (1, 11, 20, 1000):
        parts = [p.column("text").to_pylist() for p in parts_by_bytes(batch, "text", most)]
        assert sum(parts, []) == texts
        assert all(len(p) == 1 or sum(len((t or "").encode()) for t in p) <= most for p in parts)
    assert list(parts_by_bytes(batch.slice(0, 0), "text")) == []


def test_common_chunks_outlast_rare_ones():
    """A full cache keeps what is met again and again; rare chunks don't push it out."""
    asked = []
    run = ChunkEncoder(lambda chunks: asked.extend(chunks) or [c.encode() for c in chunks], limit=20)
    for i in range(100):
        text = f"x often a{i} b{i} c{i}"
        assert run(text) == text.encode()
        assert len(run.cache) + len(run.old) <= 20
    assert asked.count(" often") == 1


def test_machine_starts_again_without_circles():
    """States point at one another; a table that is full is taken apart, as workers rest the cycle collector."""
    machine = Transducer(load_ranks(RANKS), bound=30)
    first = machine.start
    machine.encode(b"understandingly, the other one " * 5)
    assert machine.start is not first and not first


def test_transducer_is_plain_bpe():
    ranks = load_ranks(RANKS)
    want = reference_bpe(ranks)
    for bound in (1_000_000, 300):
        run = ChunkEncoder(transducer_encoder(ranks, public_tokenizers.PATTERN))
        machine = Transducer(ranks, bound)
        for t in [*fuzz_texts(2000, bound), "a" * 4000, " " * 3000, "é" * 777]:
            assert ids_of(run(t)).tolist() == want(t)
        for t in ("understandingly", "aaaaaaaaaaaaa", "中中中", "====--==="):
            assert machine.encode(t.encode()) == want(t)


def test_utf8_machine_matches_whole_decoding():
    rng = random.Random(3)
    for _ in range(5000):
        data = bytes(rng.choice([0x41, 0x80, 0xBF, 0xC2, 0xE0, 0xA0, 0xED, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xFF]) for _ in range(rng.randint(0, 9)))
        m, k = Utf8Machine(), rng.randint(1, 4)
        assert "".join(m.feed(data[i : i + k]) for i in range(0, len(data), k)) + m.finish() == data.decode("utf-8", "replace")


def test_stream_decoder_cuts_inside_characters():
    ranks = load_ranks(RANKS)
    ids = reference_bpe(ranks)("🙂 é中🙂🙂 x" * 50)
    for piece in (1, 2, 7, 4096):
        assert "".join(StreamDecoder(ranks).decode(ids, piece)) == "🙂 é中🙂🙂 x" * 50


def check_bpe(df):
    want = reference_bpe(load_ranks(RANKS))
    got = encode_decode(df, RANKS, public_tokenizers.PATTERN).drop("ids", "decoded").collect()
    expected = []
    for r in df.select("doc_id", "text").collect():
        ids = want(r.text or "")
        expected.append((r.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))


def test_encode_decode_odd_rows(spark):
    df = odd_documents(spark)
    check_bpe(df)
    assert encode_decode(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


@here
def test_encode_decode_documents(spark):
    check_bpe(table(spark, "documents"))


def test_variable_length_codes_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 3, 4, 5, 1000):
        ranks = rng.choice([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], n).astype(np.uint32)
        control, data = pack_ranks(ranks)
        assert len(control) == -(-n // 4)
        assert (unpack_ranks(control, data, n) == ranks).all()
    docs, counts, got = read_block(write_block([3, None, 9], [1, 0, 2], np.array([7, 300, 70000])))
    assert (docs, counts.tolist(), got.tolist()) == ([3, None, 9], [1, 0, 2], [7, 300, 70000])


def check_files(df):
    want = library("word_bpe_49k.json")
    out = token_files(df, public_tokenizers.path("word_bpe_49k.json")).collect()
    got = sorted(out, key=lambda r: r["start"])
    place, last = 0, None
    for r in got:
        assert r["start"] == place and r["n_tokens"] * 4 == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(r["ids"])
        assert last is None or r["doc_id"] >= last
        place, last = place + r["n_tokens"], r["doc_id"]
    expected = [(r.doc_id, np.array([*want(r.text or ""), 2], "<u4").tobytes()) for r in df.select("doc_id", "text").collect()]
    assert sorted((repr(r["doc_id"]), bytes(r["ids"])) for r in got) == sorted((repr(d), b) for d, b in expected)


def test_token_files_odd_rows(spark):
    df = odd_documents(spark)
    check_files(df)
    assert token_files(df.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0


@here
def test_token_files_documents(spark):
    check_files(table(spark, "documents"))


def check_pieces(df, size):
    want = library("byte_bpe_50k.json")
    out = pack(df, public_tokenizers.path("byte_bpe_50k.json"), size=size)
    rows = [r.asDict() for r in out.collect()]
    expected, lengths = [], []
    for r in df.select("doc_id", "text").collect():
        ids = np.array([*want(r.text or ""), 0], "<u4")
        first = (len(ids) - 1) % size + 1
        for k, (a, b) in enumerate([(0, first), *((a, a + size) for a in range(first, len(ids), size))]):
            expected.append((r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            lengths.append(b - a)
    assert sorted(map(repr, expected)) == sorted(repr((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in rows)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in sequences.values():
        place = 0
        for offset, length in sorted(s):
            assert offset == place
            place += length
        assert place <= size
    return len(sequences), lengths


def first_fit_decreasing(lengths, size):
    free = []
    for n in sorted(lengths, reverse=True):
        i = next((i for i, f in enumerate(free) if f >= n), None)
        if i is None:
            free.append(size - n)
        else:
            free[i] -= n
    return len(free)


def test_packing_odd_rows(spark):
    df = odd_documents(spark)
    for size in (2048, 7, 1):
        n, lengths = check_pieces(df, size)
        assert n <= first_fit_decreasing(lengths, size)
    assert pack(df.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


@here
def test_packing_documents(spark):
    n, lengths = check_pieces(table(spark, "documents"), 2048)
    assert n <= min(first_fit_decreasing(lengths, 2048), -(-sum(lengths) // 2048) + 2)


def test_plans_use_every_piece_once():
    rng = np.random.default_rng(5)
    for _ in range(200):
        size = int(rng.integers(1, 40))
        histogram = np.append(0, rng.integers(0, 30, size) * (rng.random(size) < 0.5)).astype(np.int64)
        for plan in (best_fit(histogram.copy()), plan_patterns(histogram, 50)):
            used = np.zeros(size + 1, np.int64)
            for pattern, n in plan.items():
                assert n > 0 and 0 < sum(pattern) <= size
                for x in pattern:
                    used[x] += n
            assert (used == histogram).all()
        lengths = np.repeat(np.arange(size + 1), histogram)
        assert sum(best_fit(histogram.copy()).values()) <= first_fit_decreasing(lengths, size) + 1
