"""Document fingerprints: threshold-scaled sketches.

Sketch. Every shingle of ``SHINGLE`` code points is hashed to 64 bits; the
sketch keeps all distinct hashes below a fixed fraction (1 / 16) of the range,
so its size follows the text and the sketch of a union is the union of the
sketches. Shared share of hashes therefore estimates containment without bias
even between a paragraph and a book, where sketches of a fixed size hold too
few of the book's hashes. A text without a hash that low keeps its smallest
hash instead; merging keeps that rule, so sketches merge exactly.

A kept hash is below 2^60; its upper 32 bits are stored, as 8 hexadecimal
digits, ascending. A smallest hash kept instead takes 9 digits.

Edited texts (``edited_table``). Documents stand in descending order of
doc_id, the first after the last. A document's edited text swaps its last
third for the first code points of the next document. For that each document
must meet the next one: boundaries sampled from the ids cut the order into
blocks, each block also gets the first document of the block after it, and one
shuffle by block brings whole texts together once. A task streams through its
sorted blocks and holds two documents at a time.

Defined cases: a null text counts as empty; a text shorter than a shingle is
one shingle; an empty text has the empty sketch, like only to itself; null
doc_ids come last; rows of one doc_id stand in the order of the table, and
their repeats are cut into several blocks like any other rows; one row alone
is its own next; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 12
#: One hash in 2^SCALE is kept, with KEPT of its bits.
SCALE, KEPT = 4, 32
_MULTIPLY = 0x9E3779B97F4A7C15
#: Rows of a block that its size aims at, sampled ids per block, and blocks
#: for each shuffle partition at most.
BLOCK_ROWS, SAMPLED, BLOCKS_A_PARTITION = 256, 64, 4
_GROUP = 64


# ------------------------------------------------------------------- sketches

def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "replace"), dtype="<u4")


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(points: np.ndarray) -> np.ndarray:
    """One hash per shingle, in text order; the parts of a shingle are joined
    by doubling: 1, 2, 4, 8 and 8 + 4 code points."""
    c = points.astype(np.uint64) + np.uint64(1)
    if len(c) == 0:
        return c
    if len(c) < SHINGLE:  # one shingle, told apart by its length
        value = len(c)
        for x in c.tolist():
            value = (value * _MULTIPLY + x) % (1 << 64)
        return _mixed(np.array([value], dtype=np.uint64))
    power = [pow(_MULTIPLY, n, 1 << 64) for n in (1, 2, 4)]
    two = c[:-1] * np.uint64(power[0]) + c[1:]
    four = two[:-2] * np.uint64(power[1]) + two[2:]
    eight = four[:-4] * np.uint64(power[2]) + four[4:]
    return _mixed(eight[:-4] * np.uint64(power[2]) + four[8:])


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Ascending kept values of a text's shingle hashes."""
    cut = np.uint64(64 - SCALE - KEPT)
    low = hashes[hashes < np.uint64(1 << (64 - SCALE))]
    if len(low):
        return np.unique(low >> cut)
    return hashes.min(keepdims=True) >> cut if len(hashes) else hashes


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    both = np.union1d(a, b)
    low = both[both < np.uint64(1 << KEPT)]
    return low if len(low) else both[:1]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common shingles among all of both (Jaccard)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of a's shingles that b holds; of none, all."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def to_text(s: np.ndarray) -> str:
    if len(s) == 1 and s[0] >> np.uint64(KEPT):
        return f"{int(s[0]):09x}"
    return s.astype(">u4").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    if len(text) == 9:
        return np.array([int(text, 16)], dtype=np.uint64)
    return np.frombuffer(bytes.fromhex(text), dtype=">u4").astype(np.uint64)


class Sketched:
    """A document with its code points, shingle hashes and sketch."""

    __slots__ = ("doc_id", "points", "hashes", "kept")

    def __init__(self, doc_id: int | None, text: str | None):
        self.doc_id, self.points = doc_id, code_points(text)
        self.hashes = shingle_hashes(self.points)
        self.kept = sketch(self.hashes)

    def edited(self, following: Sketched) -> tuple[np.ndarray, np.ndarray]:
        """Code points and shingle hashes of the edited text; shingles inside
        the part that stays are not hashed again."""
        swap = len(self.points) // 3
        stay = self.points[:len(self.points) - swap]
        points = np.concatenate([stay, following.points[:swap]])
        if len(points) < SHINGLE:
            return points, shingle_hashes(points)
        seam = points[max(0, len(stay) - SHINGLE + 1):]
        new = shingle_hashes(seam) if len(seam) >= SHINGLE else self.hashes[:0]
        return points, np.concatenate([self.hashes[:max(0, len(stay) - SHINGLE + 1)], new])


# ------------------------------------------------------------- whole documents

def sketch_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of every whole text; one narrow pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [Sketched(None, t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(d.points) for d in done], pa.int64()),
                 pa.array([to_text(d.kept) for d in done], pa.string())], names=["doc_id", "n_chars", "fingerprint"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def _at(a: Column, b: Column) -> Column:
    return F.struct(a.alias("k"), b.alias("s"))


def _block(key: Column, bounds: Sequence[tuple[int, int]]) -> Column:
    """How many bounds are not above the key, found in two steps."""
    def array(of):  # as SQL text: one parse, not a call per bound
        return F.expr("array(" + ", ".join(
            f"named_struct('k', bigint('{k}'), 's', bigint('{s}'))" for k, s in of) + ")")

    def below(among: Column) -> Column:
        return F.size(F.filter(among, lambda b: b <= key))

    if not bounds:
        return F.lit(0)
    if len(bounds) <= _GROUP:
        return below(array(bounds))
    group = below(array(bounds[::_GROUP])) - 1
    inside = below(F.slice(array(bounds), group * _GROUP + 1, F.lit(_GROUP)))
    return F.when(group < 0, 0).otherwise(group * _GROUP + inside)


def in_blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """(rows, blocks): doc_id, text, block, halo, k, s. (k, s) is descending
    doc_id and place in the table. A block's last row has ``halo`` set: a copy
    of the first row of the block after it (after the last: the first).

    At the driver: the sampled ids (SAMPLED a block) and one row per block.
    """
    spark = docs.sparkSession
    key = F.col("doc_id").cast("long")
    # The bitwise not falls as x rises, for every long; null doc_ids come last.
    rows = docs.select(key.alias("doc_id"), "text",
                       F.bitwise_not(F.coalesce(key, F.lit(-(1 << 63)).cast("long"))).alias("k"),
                       F.monotonically_increasing_id().alias("s"))
    n = rows.count()
    most = BLOCKS_A_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, min(most, n // BLOCK_ROWS))
    bounds: list[tuple[int, int]] = []
    if blocks > 1:
        some = rows.select("k", "s").sample(min(1.0, SAMPLED * blocks / n), seed=13).toArrow()
        order = sorted(zip(some.column("k").to_pylist(), some.column("s").to_pylist(), strict=True))
        bounds = sorted({order[i * len(order) // blocks] for i in range(1, blocks)}) if order else []
    block = _block(_at(F.col("k"), F.col("s")), bounds)
    rows = rows.withColumn("block", block.cast("int"))
    heads = sorted((r["block"], r["h"]["k"], r["h"]["s"]) for r in rows.groupBy("block").agg(
        F.min(F.struct("k", "s")).alias("h")).collect())
    lead = spark.createDataFrame(
        [(k, s, heads[i - 1][0]) for i, (_, k, s) in enumerate(heads)], "k long, s long, before int")
    # One row per block, at most BLOCKS_A_PARTITION of them a partition.
    halo = rows.join(F.broadcast(lead), ["k", "s"]).select(
        "doc_id", "text", F.col("before").alias("block"), F.lit(True).alias("halo"), "k", "s")
    own = rows.select("doc_id", "text", "block", F.lit(False).alias("halo"), "k", "s")
    return own.unionByName(halo), blocks


def edited_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next (Jaccard) and held_edited, held_next (share of the
    document's shingles that the other text holds), one row per row."""
    rows, _ = in_blocks(docs)
    dealt = rows.repartition("block").sortWithinPartitions("block", "halo", "k", "s")
    out = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double, held_edited double, held_next double")
    names = [c.split()[0] for c in out.split(", ")]
    kinds = [{"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[c.split()[1]] for c in out.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: Sketched | None = None
        done: list[tuple] = []
        size = 0
        for b in batches:
            for doc_id, text, halo in zip(*(b.column(i) for i in (0, 1, 3)), strict=True):
                now = Sketched(doc_id.as_py(), text.as_py())
                if before is not None:
                    points, hashes = before.edited(now)
                    edited = sketch(hashes)
                    done.append((
                        before.doc_id, len(before.points),
                        hashlib.sha256(points.tobytes().decode("utf-32-le").encode()).hexdigest(),
                        to_text(before.kept), to_text(edited),
                        likeness(before.kept, edited), likeness(before.kept, now.kept),
                        containment(before.kept, edited), containment(before.kept, now.kept)))
                    size += len(before.kept)
                    if len(done) >= 1024 or size > 1 << 20:
                        yield _batch(done, names, kinds)
                        done, size = [], 0
                before = None if halo.as_py() else now
        if done:
            yield _batch(done, names, kinds)

    return dealt.mapInArrow(run, out)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
