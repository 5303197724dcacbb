"""SimHash near-copies by Golay-code fuzzy hashing.

Fingerprint. 64 bits by majority over the XXH64 of every word shingle.

Keys. Fingerprints are cut into three segments (22, 21, 21 bits), each padded
into the 23-bit space of the perfect Golay code. A segment's indices are the
codewords within 4 bits: 1 or 6 of the 4,096. Two segments that differ in at
most 2 bits always share one. With at most 2 differing bits in all, at least
one of the three segments has no error (pigeonhole), so two linked
fingerprints share, for that segment, the key (segment number, its exact
value, an index of the next segment). Distinct fingerprints are joined on the
key and every pair is verified by its bit distance.

Dense buckets. A bucket of more than ``bucket_pairs`` distinct fingerprints
is not paired. Its members are linked through middles instead: fingerprints
at distance 2 or less have a common neighbour within one bit of both, so each
member lists itself and its 64 one-bit changes, and every list entry links
its members to the smallest. That is linear in the members and loses no link.

Groups. Documents with equal fingerprints are one node from the start (a
counted, map-side combined grouping), so thousands of copies cost one row.
Components come from alternating large-star and small-star steps on the edges
of distinct fingerprints; each step is a written table.

Defined cases: a null text counts as empty; without words the fingerprint is
zero and linked like any other; fewer words than a shingle form one shingle;
null doc_ids take part, and sort after every id when a component has others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

SEGMENTS = ((0, 22), (22, 21), (43, 21))  # (lowest bit, bits)
BUCKET_PAIRS = 64
_BLOCK = 65_536


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """SimHash of the whole text; ASCII case and white space do not count."""
    import xxhash

    w = (text or "").encode("utf-8", "replace").lower().split()
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum([len(x) + 1 for x in w]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, len(w))
    cuts = list(zip(starts[:len(w) - k + 1].tolist(), ends[k - 1:].tolist(), strict=True))
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(cuts), _BLOCK):
        h = np.array([digest(joined[a:b], seed) for a, b in cuts[at:at + _BLOCK]], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(cuts), bitorder="little").view("<u8")[0])


def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By syndrome: the error of weight at most 3, and for syndromes of
    weight-3 errors the five of weight 4 (else zeros); and the syndrome table
    by halves of a word."""
    generator = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1

    def remainder(x: int) -> int:
        for b in range(22, 10, -1):
            if x >> b & 1:
                x ^= generator << (b - 11)
        return x

    bit = [remainder(1 << b) for b in range(23)]
    near = np.zeros(2048, dtype=np.int64)
    more: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(1, 5):
        for c in combinations(range(23), weight):
            s = e = 0
            for b in c:
                s ^= bit[b]
                e |= 1 << b
            if weight < 4:
                near[s] = e
            else:
                more[s].append(e)
    far = np.array([m[:5] if near[s].bit_count() == 3 else [0] * 5 for s, m in enumerate(more)], dtype=np.int64)
    halves = np.zeros((2, 4096), dtype=np.int64)
    for x in range(4096):
        for b in range(12):
            if x >> b & 1:
                halves[0, x] ^= bit[b]
                if b < 11:
                    halves[1, x] ^= bit[b + 12]
    return near, far, halves


_tables: list = []


def codewords(segment: np.ndarray) -> np.ndarray:
    """Indices (of 4,096) of the codewords within 4 bits: n x 6; where a
    segment has one only, it fills the row."""
    if not _tables:
        _tables.extend(_golay())
    near, far, halves = _tables
    s = halves[0, segment & 4095] ^ halves[1, segment >> 12]
    first = segment ^ near[s]
    rest = np.where(far[s] > 0, segment[:, None] ^ far[s], first[:, None])
    return np.concatenate([first[:, None], rest], axis=1) >> 11  # the message bits


def _segments(fp: np.ndarray) -> list[np.ndarray]:
    u = fp.view(np.uint64)
    return [((u >> np.uint64(lo)) & np.uint64((1 << n) - 1)).astype(np.int64) for lo, n in SEGMENTS]


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, fingerprint) pairs, each key once a fingerprint."""
    seg = _segments(fp)
    keys, of = [], []
    for i in range(3):
        index = np.sort(codewords(seg[(i + 1) % 3]), axis=1)
        fresh = np.concatenate([np.ones((len(fp), 1), bool), index[:, 1:] != index[:, :-1]], axis=1)
        key = (np.int64(i) << 34) | (seg[i][:, None] << 12) | index
        keys.append(key[fresh])
        of.append(np.repeat(fp, fresh.sum(axis=1)))
    return np.concatenate(keys), np.concatenate(of)


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), words, seed) for t in b.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def links(fps: DataFrame, distance: int = 2, bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """Edges (a, b) among distinct fingerprints ``fp``: every pair within
    ``distance`` bits is an edge or connected through edges."""
    if distance > 2:
        raise ValueError("the keys hold for at most 2 differing bits")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, fp = golay_keys(b.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp)], names=["key", "fp"])

    keys = fps.select("fp").mapInArrow(keyed, "key long, fp long")
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    posts = stage(keys.join(stage(shared, "golay-buckets"), "key"), "golay-posts")
    few = posts.where(F.col("n") <= bucket_pairs)
    a, b = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = a.join(b, "key").where((F.col("a") < F.col("b")) & near).select("a", "b")
    # Dense buckets: by middles, for distances 1 and 2 (distance 0 has no edge).
    many = posts.where(F.col("n") > bucket_pairs).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *(F.shiftleft(F.lit(1).cast("long"), i) for i in range(64)))
    if distance == 2:
        middles = many.select("fp", F.explode(F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("mid"))
        heads = middles.groupBy("mid").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
        dense = middles.join(heads, "mid").where(F.col("fp") != F.col("a")).select("a", F.col("fp").alias("b"))
    else:  # x and its one-bit changes: the pair itself
        flipped = many.select(F.col("fp").alias("a"), F.explode(
            F.transform(flips, lambda x: F.col("fp").bitwiseXOR(x))).alias("b"))
        dense = flipped.join(many.withColumnRenamed("fp", "b"), "b").where(
            (F.col("a") < F.col("b")) & F.lit(distance >= 1)).select("a", "b")
    return pairs.unionByName(dense).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with an edge.

    Large-star hands a node's larger neighbours to its smallest one, small-star
    its smaller ones; both keep connectivity and the number of edges does not
    grow. The steps end when every edge points at a root."""
    e = stage(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
              .where("u <> v").distinct(), "edges")
    size = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stage(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        e = stage(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                  .unionByName(small.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        # Done when every edge leads to a node that has no smaller neighbour,
        # and nodes have one edge each: (edges, sum of v) no longer changes.
        now = e.agg(F.count("*"), F.sum(F.col("v").cast("decimal(38,0)")), F.count_distinct("u")).first()
        if now[0] == now[2] and now == size:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        size = now


def near_copies(docs: DataFrame, words: int = 3, distance: int = 2, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id that
    links reach, itself included); one row per row of docs."""
    marks = stage(fingerprints(docs, words, seed), "fingerprints")
    classes = stage(marks.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    roots = components(links(classes, distance))
    # Components of more than one fingerprint are few rows beside classes.
    grown = stage(classes.join(roots, classes.fp == roots.node).select("fp", "rep", "root"), "grown")
    least = stage(grown.select("root", "rep").unionByName(
        classes.join(grown.select(F.col("root").alias("fp")).distinct(), "fp").select(F.col("fp").alias("root"), "rep"))
        .groupBy("root").agg(F.min("rep").alias("least")), "least")
    named = stage(grown.select("fp", "root").unionByName(least.select(F.col("root").alias("fp"), "root"))
                  .join(least, "root").select("fp", "least"), "named")
    ids = stage(classes.join(named, "fp", "left").select("fp", F.coalesce("least", "rep").alias("component_id")), "ids")
    return marks.join(ids, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
