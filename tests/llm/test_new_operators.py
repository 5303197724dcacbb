"""Alignment, importance resampling and scaled sketches against brute force."""

from __future__ import annotations

import functools
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import importance_resampling as ir
from tidemark.llm import registry, scaled_sketch, token_alignment
from tidemark.llm.byte_bpe import shown_bytes
from tidemark.llm.common import heavy_join, table

SF = "/root/testdata/sf0.001"
BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def repeated(df, times):
    out = df
    for _ in range(times - 1):
        out = out.unionByName(df)
    return out


# --------------------------------------------------------------- 11: alignment

@functools.cache
def libraries():
    a = Tokenizer.from_file(BYTE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE)


def slow_align(docs):
    """Every document by the libraries, byte by byte."""
    a_lib, b_lib = libraries()
    byte = {chr(s): b for b, s in shown_bytes().items()}
    links, shown = {}, {}
    for row, (_, text) in enumerate(docs):
        links[row], shown[row] = [], (0, 0, 0, "")
        if not text:
            continue
        a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
        ab = [bytes(byte[c] for c in a_lib.id_to_token(i)) for i in a]
        bb = [bytes([int(p[3:-1], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()
              for i, p in zip(b, map(b_lib.id_to_piece, b), strict=True)]
        if not b"".join(ab) == b"".join(bb) == (" " + text).encode():
            continue
        own_a = [i for i, x in enumerate(ab) for _ in x]
        own_b = [i for i, x in enumerate(bb) for _ in x]
        links[row] = [(a[i], b[j]) for i, j in sorted(set(zip(own_a, own_b, strict=True)))]
        ends = sorted(set(np.cumsum([len(x) for x in ab])) & set(np.cumsum([len(x) for x in bb])))
        groups, at = [], 0
        for e in ends:
            ga, gb = [a[i] for i in sorted(set(own_a[at:e]))], [b[j] for j in sorted(set(own_b[at:e]))]
            groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
            at = e
        shown[row] = (len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest())
    count = Counter(p for ls in links.values() for p in ls)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return Counter((docs[row][0], *shown[row][:3], len(ls), sum(count[p] == best[p[1]] for p in ls),
                    sum(count[p] for p in ls), shown[row][3]) for row, ls in links.items())


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_op11(spark):
    got = registry.op11_token_alignment(spark, SF)
    assert dict(got.dtypes) == {c: "string" if c == "groups_sha256" else "bigint" for c in COLUMNS}
    want = slow_align(rows_of(table(spark, SF, "documents")))
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got.collect()) == want


@pytest.mark.parametrize("held", [token_alignment.HELD_PAIRS, 3, 0])
def test_alignment_odd_rows(spark, odd_docs, held):
    """Repeated rows, literal word marks, added-token strings, null ids; pairs
    valued by broadcast, by both ways, by the join alone."""
    more = odd_docs.where("doc_id = 14")
    docs = odd_docs.unionByName(repeated(more, 5))
    got = token_alignment.align_table(docs, BYTE, PIECE, held_pairs=held).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == slow_align(rows_of(docs))


def test_alignment_of_nothing(spark, no_docs):
    assert token_alignment.align_table(no_docs, BYTE, PIECE).collect() == []


ALPHABET = [*" \n\t▁aetñoA.,!0129éß中😀́\x00\x1c 　", "<s>", "<0x0A>", "   ", "ing", "the ", "'s", "<|endoftext|>"]


@functools.cache
def own_aligner():
    return token_alignment.Aligner(BYTE, PIECE)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=30).map("".join), max_size=5))
def test_batches_equal_single_texts(batch):
    al = own_aligner()
    want = slow_align(list(enumerate(batch)))
    got = Counter()
    for i, x in enumerate(al.texts(batch)):
        codes, groups, n_a, n_b, n_groups = x or ((), b"", 0, 0, 0)
        got[i, n_a, n_b, n_groups, len(codes), hashlib.sha256(groups).hexdigest() if groups else ""] += 1
    assert got == Counter((*r[:5], r[7]) for r in want.elements())


def test_heavy_join_broadcasts_hot_keys_only(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 40}") for i in range(300)] + [(300, None), (301, "new")],
                                 "i int, key string")
    facts = rows.where("key is not null and key <> 'new'").groupBy("key").count().selectExpr(
        "key", "count as copies", "upper(key) as fact")
    got = {(r["i"], r["fact"]) for r in heavy_join(rows, facts, "key", "copies", 10).collect()}
    assert got == {(r["i"], None if r["key"] in (None, "new") else r["key"].upper()) for r in rows.collect()}


# ------------------------------------------------------------- 12: resampling

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def slow_words(text):
    return _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow_buckets(text):
    w = slow_words(text)
    return [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def slow_resample(docs, target, percent=5, least=20):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(slow_buckets(x))
    for x in target:
        t.update(slow_buckets(x))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in range(10_000)]
    rows = []
    for at, (d, x) in enumerate(docs):
        f = slow_buckets(x)
        h = int(hashlib.sha256(f"42:{'null' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append((d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), at))
    fit = [r for r in rows if len(slow_words(docs[r[4]][1])) >= least]
    fit.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {r[4]: i + 1 for i, r in enumerate(fit[:len(fit) * percent // 100])}
    return Counter((*r[:4], rank.get(r[4])) for r in rows)


def drawn(df):
    return Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in df.collect())


def test_op12(spark):
    docs = rows_of(table(spark, SF, "documents"))
    target = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    got = registry.op12_importance_resampling(spark, SF)
    assert all(t == "bigint" for _, t in got.dtypes)
    assert drawn(got) == slow_resample(docs, target)


def test_resampling_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.unionByName(repeated(odd_docs.where("doc_id = 12"), 4)).unionByName(odd_docs.where("doc_id is null"))
    for target in (odd_docs.where("doc_id = 14"), no_docs):
        for percent, least in ((50, 0), (5, 20), (100, 5)):
            got = ir.resample(docs, target, percent=percent, least_words=least)
            want = slow_resample(rows_of(docs), [r["text"] for r in target.collect()], percent, least)
            assert drawn(got) == want
    assert ir.resample(no_docs, odd_docs).collect() == []


def test_chunked_features(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice(["word", "Ähre", "é", "B2", " ", "-", ". ", "\n", "漢字", "x"]) for _ in range(5_000))
    want = Counter(slow_buckets(text))
    for chunk in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(ir, "CHUNK", chunk)
        n, parts = ir.features(text)
        assert n == len(slow_words(text))
        assert Counter(np.concatenate(parts).tolist()) == want


# ---------------------------------------------------------------- 13: sketches

def slow_sketch(text):
    """Shingle by shingle with Python's integers."""
    m, top = 0x9E3779B97F4A7C15, 1 << 64
    c = [ord(x) + 1 for x in text or ""]
    found = set()
    for s in [c[i:i + 12] for i in range(len(c) - 11)] or ([c] if c else []):
        h = 0 if len(s) == 12 else len(s)
        for x in s:
            h = (h * m + x) % top
        h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 % top
        h = (h ^ h >> 27) * 0x94D049BB133111EB % top
        found.add(h ^ h >> 31)
    low = {h >> 28 for h in found if h < 1 << 60}
    return low or ({min(found) >> 28} if found else set())


def slow_fingerprint(s):
    return "".join(f"{x:08x}" for x in sorted(s))


def slow_edited(docs):
    """docs in descending order: rows of the edited table."""
    out = []
    for i, (d, t) in enumerate(docs):
        t, after = t or "", docs[(i + 1) % len(docs)][1] or ""
        swap = len(t) // 3
        edited = t[:len(t) - swap] + after[:swap]
        a, e, n = slow_sketch(t), slow_sketch(edited), slow_sketch(after)
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), slow_fingerprint(a), slow_fingerprint(e),
                    round(like(a, e), 9), round(like(a, n), 9)))
    return out


def edited(df):
    return Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"],
                    round(r["near_edited"], 9), round(r["near_next"], 9)) for r in df.collect())


def test_op13(spark, monkeypatch):
    docs = sorted(rows_of(table(spark, SF, "documents")), reverse=True)
    want = Counter(slow_edited(docs))
    assert edited(registry.op13_scaled_sketch(spark, SF)) == want
    for rows, per_partition in ((3, 40), (1, 100), (70, 1)):  # many blocks, some of one row, two-step search
        monkeypatch.setattr(scaled_sketch, "BLOCK_ROWS", rows)
        monkeypatch.setattr(scaled_sketch, "BLOCKS_A_PARTITION", per_partition)
        monkeypatch.setattr(scaled_sketch, "_GROUP", 7)
        assert edited(registry.op13_scaled_sketch(spark, SF)) == want


def test_sketch_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(scaled_sketch, "BLOCK_ROWS", 2)
    rows = rows_of(odd_docs)
    got = edited(scaled_sketch.edited_table(odd_docs))
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0)))  # stable: repeats in the table's order
    assert got == Counter(slow_edited(rows))
    assert scaled_sketch.edited_table(no_docs).collect() == []
    one = odd_docs.where("doc_id = 12")
    assert edited(scaled_sketch.edited_table(one)) == Counter(slow_edited(rows_of(one)))


def test_hot_doc_id_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(scaled_sketch, "BLOCK_ROWS", 50)
    docs = spark.range(900).selectExpr("if(id % 3 = 0, 7L, id) as doc_id", "concat('text number ', id) as text").coalesce(1)
    rows, blocks = scaled_sketch.in_blocks(docs)
    most = max(r["count"] for r in rows.groupBy("block").count().collect())
    assert blocks == 18 and most < 150
    want = sorted(rows_of(docs), key=lambda r: -r[0])
    assert edited(scaled_sketch.edited_table(docs)) == Counter(slow_edited(want))


def test_sketches_merge_and_estimate_containment():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(3_000)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    sk = lambda t: scaled_sketch.sketch(scaled_sketch.shingle_hashes(scaled_sketch.code_points(t)))
    book = prose(40_000)
    part = book[50_000:60_000]
    half = book[70_000:80_000] + prose(1_700)
    assert scaled_sketch.containment(sk(part), sk(book)) == 1.0
    assert abs(scaled_sketch.containment(sk(half), sk(book)) - 0.5) < 0.08
    assert scaled_sketch.containment(sk(prose(2_000)), sk(book)) < 0.02
    assert scaled_sketch.likeness(sk(part), sk(book)) < 0.1
    for a, b in (("short", "text"), ("", "text"), (prose(4), prose(5)), (prose(100), "one"), (part, half)):
        # A text whose shingles are just those of both: merge equals its sketch.
        both = np.concatenate([scaled_sketch.shingle_hashes(scaled_sketch.code_points(x)) for x in (a, b)])
        assert scaled_sketch.merge(sk(a), sk(b)).tolist() == scaled_sketch.sketch(both).tolist()
    for t in ("", "a", "short", part):
        assert scaled_sketch.from_text(scaled_sketch.to_text(sk(t))).tolist() == sk(t).tolist()


def test_sketch_table(spark, odd_docs):
    got = Counter((r["doc_id"], r["n_chars"], r["fingerprint"]) for r in scaled_sketch.sketch_table(odd_docs).collect())
    assert got == Counter((d, len(t or ""), slow_fingerprint(slow_sketch(t))) for d, t in rows_of(odd_docs))
