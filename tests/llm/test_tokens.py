"""Tokenisation, token files and packing against the libraries themselves."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing, piece_bpe, token_frames
from tidemark.llm.byte_bpe import ByteBpe, encoder
from tidemark.llm.common import shared_path

BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = [*" \n\t▁aetñoA.,!0129éß中😀́\x00\x1c", "<s>", "<0x0A>", "   ", "ing", "the ", "'s", "<|endoftext|>"]
texts = st.lists(st.sampled_from(ALPHABET), max_size=40).map("".join)


@pytest.fixture(scope="module")
def byte_library():
    t = Tokenizer.from_file(BYTE)
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def pieces():
    return piece_bpe.PieceBpe(PIECE, memo_words=50), sentencepiece.SentencePieceProcessor(model_file=PIECE)


@settings(max_examples=300, deadline=None)
@given(st.lists(texts, max_size=6))
def test_byte_ids_equal_library(byte_library, batch):
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder(BYTE).encode(batch)] == [byte_library(t) for t in batch]


def test_added_tokens_and_long_runs_equal_library(byte_library):
    enc = ByteBpe(BYTE)
    for t in ("a <|endoftext|> b", "<|endoftext|><|endoftext|>", " <|endoftext|>\n", "x" * 1_000_000, " " * 1_000_000 + "y",
              "\n" * 500_000, "ab" * 300_000 + " <|endoftext|>"):
        assert np.frombuffer(enc.encode([t])[0], "<u4").tolist() == byte_library(t)
    assert np.frombuffer(enc.encode(["a <|endoftext|> b"])[0], "<u4").tolist() == [64, 220, 50256, 275]
    plain = Tokenizer.from_file(BYTE)
    plain.encode_special_tokens = True
    t = "a <|endoftext|> b"
    assert (np.frombuffer(ByteBpe(BYTE, plain_specials=True).encode([t])[0], "<u4").tolist()
            == plain.encode(t, add_special_tokens=False).ids)


def test_long_word_equals_library(pieces):
    own, lib = pieces
    rng = random.Random(4)
    word = "".join(rng.choice("etaoinshrdlu") for _ in range(1_000_000))
    assert own.encode(word) == lib.encode(word, add_eos=True)


@settings(max_examples=500, deadline=None)
@given(texts)
def test_pieces_equal_library(pieces, text):
    own, lib = pieces
    ids = own.encode(text)
    assert ids == lib.encode(text, add_eos=True)
    assert own.decode(ids) == lib.decode(ids)


def test_any_ids_decode_as_library(pieces):
    own, lib = pieces
    rng = random.Random(1)
    for _ in range(2_000):
        ids = [rng.choice([rng.randrange(32_000), rng.randrange(3, 259)]) for _ in range(rng.randrange(9))]
        assert own.decode(ids) == lib.decode(ids)


def test_backtracking_equals_plain_merging(pieces):
    own, _ = pieces
    rng = random.Random(2)
    for _ in range(500):
        t = "▁" + "".join(rng.choice("ertyioanthsing") for _ in range(rng.randrange(30)))
        assert own.pieces(t) == own.merged(t)


def test_piece_table(spark, odd_docs, no_docs):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    rows = piece_bpe.encode_table(odd_docs, PIECE).collect()
    want = Counter((r["doc_id"], tuple(lib.encode(r["text"] or "", add_eos=True))) for r in odd_docs.collect())
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == want
    assert all(r["decoded"] == lib.decode(r["ids"]) and r["n_tokens"] == len(r["ids"]) for r in rows)
    assert piece_bpe.encode_table(no_docs, PIECE, digest=True).collect() == []


def test_frame_file_random_access(tmp_path):
    body = {i: bytes([i % 251, 1, 2, 3]) * (i % 40) for i in range(200)}
    with open(tmp_path / "f", "wb") as out:
        w = token_frames.FrameWriter(out)
        for i, b in body.items():
            w.add(None if i == 7 else i, b)
        w.close()
    size = (tmp_path / "f").stat().st_size
    with open(tmp_path / "f", "rb") as src:
        r = token_frames.FrameReader(src, size)
        assert r.doc_ids == [None if i == 7 else i for i in body]
        for k in (0, 199, 41, 7, 40):
            assert r.frame(k) == body[k]
    # Any zstandard reader decodes the file as one stream.
    with open(tmp_path / "f", "rb") as src:
        assert zstandard.ZstdDecompressor().stream_reader(src, read_across_frames=True).read() == b"".join(body.values())
    raw = bytearray((tmp_path / "f").read_bytes())
    with open(tmp_path / "f", "rb") as src:
        at = int(token_frames.FrameReader(src, size).at[41])
    raw[at + 8] ^= 255
    (tmp_path / "g").write_bytes(raw)
    with open(tmp_path / "g", "rb") as src, pytest.raises((ValueError, zstandard.ZstdError)):
        token_frames.FrameReader(src, size).frame(41)


def test_token_files_round_trip(spark, odd_docs, no_docs, byte_library):
    path = shared_path(spark, "test-frames")
    manifest = token_frames.write_token_files(odd_docs, path, BYTE, end_id=2)
    got = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist())
           for r in token_frames.read_token_files(spark, path, manifest).collect()]
    want = [(r["doc_id"], [*byte_library(r["text"]), 2]) for r in odd_docs.collect()]
    assert Counter((d, tuple(i)) for d, _, i in got) == Counter((d, tuple(i)) for d, i in want)
    at = 0
    for d, start, ids in sorted(got, key=lambda x: x[1]):
        assert start == at
        at += len(ids)
    order = [d for d, _, _ in sorted(got, key=lambda x: x[1])]
    assert order[0] is None and order[1:] == sorted(order[1:])
    some = token_frames.read_token_files(spark, path, manifest, doc_ids=[3, 11], digest=True).collect()
    assert {r["doc_id"]: r["ids_crc32"] for r in some} == {
        d: zlib.crc32(np.array(i, "<u4").tobytes()) for d, i in want if d in (3, 11)}
    empty = token_frames.write_token_files(no_docs, shared_path(spark, "none"), BYTE)
    assert token_frames.read_token_files(spark, path, empty).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 60), max_size=30))
def test_plan_holds_histogram(histogram):
    plan = packing.plan_packing(histogram, 64)
    held = Counter()
    for config, k in plan:
        assert 0 < sum(config) <= 64 and k > 0
        for x in config:
            held[x] += k
    assert held == Counter(histogram)
    total = sum(k * v for k, v in histogram.items())
    assert sum(k for _, k in plan) <= max(1, 2 * -(-total // 64))


def test_plan_is_near_the_lower_bound():
    rng = np.random.default_rng(0)
    lengths, n = np.unique(rng.integers(1, 2_049, 40_000), return_counts=True)
    histogram = dict(zip(lengths.tolist(), n.tolist(), strict=True))
    plan = packing.plan_packing(histogram, 2_048)
    low = -(-sum(k * v for k, v in histogram.items()) // 2_048)
    assert sum(k for _, k in plan) <= low * 1.005


@pytest.mark.parametrize("histogram, sequences", [
    ({1_100: 10_000_000}, 10_000_000),
    ({1_500: 10_000_000, 700: 10_000_000, 30: 1_000_000}, 15_000_000),
    (dict.fromkeys(range(1_025, 2_049), 3) | {1_500: 10_000_000}, 10_000_000 + 3 * 1_023),
])
def test_plan_of_hot_lengths_stays_small(histogram, sequences):
    """Lengths that cannot fill a sequence: the program's configurations are
    taken, and the plan does not grow with the copies."""
    plan = packing.plan_packing(histogram, 2_048)
    held = Counter()
    for config, k in plan:
        assert 0 < sum(config) <= 2_048 and k > 0
        for x in config:
            held[x] += k
    assert held == Counter(histogram)
    assert sum(k for _, k in plan) == sequences and len(plan) <= 3 * len(histogram)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 60), max_size=30))
def test_best_fit_by_counts_equals_piece_by_piece(histogram):
    rooms = []
    for length in sorted((x for x, n in histogram.items() for _ in range(n)), reverse=True):
        at = min((r for r in rooms if r >= length), default=None)
        if at is None:
            at = 64
        else:
            rooms.remove(at)
        rooms.append(at - length)
    got = Counter()
    for config, k in packing._best_fit(histogram, 64):
        got[64 - sum(config)] += k
    assert got == Counter(rooms)


def test_packing_places_every_token(spark, odd_docs, no_docs, byte_library):
    rows = packing.pack(odd_docs, BYTE, 64, end_id=0, with_ids=True).collect()
    want = Counter((r["doc_id"], tuple([*byte_library(r["text"]), 0])) for r in odd_docs.collect())
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] <= 64 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        by_doc[r["doc_id"]].append((r["piece"], r["start"], ids))
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for seq in by_seq.values():
        at = 0
        for offset, length in sorted(seq):
            assert offset == at
            at += length
        assert at <= 64
    for (doc, ids), k in want.items():
        if k == 1:
            ps = sorted(by_doc[doc])
            assert [p for p, _, _ in ps] == list(range(len(ps)))
            assert tuple(x for _, _, i in ps for x in i) == ids
            assert all(len(i) == 64 for _, _, i in ps[1:])
    assert sum(r["length"] for r in rows) == sum(len(i) * k for (_, i), k in want.items())
    assert packing.pack(no_docs, BYTE).collect() == []


def test_hot_doc_id_takes_several_files(spark):
    docs = spark.range(0, 4_000, 1, 8).selectExpr("if(id % 3 = 0, 7L, id) as doc_id", "concat('text ', id) as text")
    path = shared_path(spark, "hot-frames")
    manifest = token_frames.write_token_files(docs, path, BYTE)
    n = [r["n_docs"] for r in manifest.collect()]
    assert len(n) == 8 and max(n) < 1_000
    got = token_frames.read_token_files(spark, path, manifest, doc_ids=[7])
    assert got.count() == docs.where("doc_id = 7").count()
