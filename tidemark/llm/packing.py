"""Best-fit packing of token sequences by a configuration linear program.

Pieces. A document is its ids plus an end id. A longer one than the capacity
is cut into full pieces; only its first piece may be shorter. Encoding is one
narrow pass: each task numbers its pieces per length, so no shuffle or window
over documents is needed to rank pieces of one length (a third of all pieces
may share one length).

Plan. Only the length histogram (at most ``capacity`` counts) reaches the
driver. A configuration is a multiset of lengths that fits one sequence. The
covering program "fewest configurations that hold every piece" is solved by
multiplicative weights: lengths still short of their count weigh more, a
knapsack dynamic program prices the best configuration for every length under
these weights, and the near-best ones gain amount together. The amounts are
rounded down, the histogram that is left is solved again, and the last rest
(under one sequence per configuration) is placed by best fit.

Places. The plan is a list of (length, first rank, copies, sequence, offset)
runs; its size follows the configurations, not the input. A piece finds its
run by its rank among the pieces of its length.

Defined cases: a null or empty text is the end id alone (one piece of length
1); repeated rows are packed as often as they occur; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import encoder
from tidemark.llm.common import stage, sub_batches

CAPACITY = 2048
#: The program is solved anew over what rounding left, so many times at most.
SOLVES = 4
#: While another solve follows, only configurations at least this full are taken.
FULL = 0.995


# ---------------------------------------------------------------- the plan
def _knapsack(value: np.ndarray, lengths: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """best[w]: most value in at most w; pick[w]: a length used there (0: none).
    Unbounded; the histogram's counts are enforced when amounts are set."""
    best = np.zeros(cap + 1)
    pick = np.zeros(cap + 1, dtype=np.int64)
    for w in range(1, cap + 1):
        best[w] = best[w - 1]
        pick[w] = 0
        k = int(np.searchsorted(lengths, w, side="right"))
        if k:
            v = best[w - lengths[:k]] + value[:k]
            i = int(v.argmax())
            if v[i] > best[w]:
                best[w], pick[w] = v[i], lengths[i]
    return best, pick


def _jumps(pick: np.ndarray) -> list[int]:
    """Per room: the largest room not above it where a length was picked."""
    at = np.where(pick > 0, np.arange(len(pick)), 0)
    return np.maximum.accumulate(at).tolist()


class _Left:
    """Amounts left per length; finds the longest length that fits a room and
    has at least one piece left, skipping used-up lengths once for all."""

    def __init__(self, lengths: np.ndarray, left: np.ndarray, cap: int):
        self.lengths, self.left = lengths.tolist(), left.tolist()
        self.under = (np.searchsorted(lengths, np.arange(cap + 1), side="right") - 1).tolist()
        self.down = list(range(len(lengths)))  # down[i]: i, or a lower one to try

    def find(self, i: int) -> int:
        path = []
        while i >= 0 and self.left[i] < 1:
            path.append(i)
            i = self.down[i] if self.down[i] < i else i - 1
        for p in path:
            self.down[p] = i
        return i

    def around(self, i: int, cap: int) -> dict[int, int]:
        """Lengths (by index) of the best-fit configuration that holds i."""
        uses, room = {i: 1}, cap - self.lengths[i]
        k = self.find(self.under[room])
        while k >= 0 and room > 0:
            c = min(room // self.lengths[k], int(self.left[k]) - uses.get(k, 0))
            if c > 0:
                uses[k] = uses.get(k, 0) + c
                room -= c * self.lengths[k]
            k = self.find(min(k - 1, self.under[room]))
        return uses


def solve_lp(lengths: np.ndarray, counts: np.ndarray, cap: int, rounds: int = 16,
             eta: float = 6.0, slack: float = 0.02) -> dict[tuple[int, ...], float]:
    """Fractional amounts of configurations that cover the histogram.

    ``held`` is the amount of each length covered so far. A length's weight is
    exponential in its shortfall against the round's target; each round prices
    under these weights, for every short length, the best configuration that
    contains it. Those within ``slack`` of the best value gain amount until
    the target is met or a length in them is used up; what stays short is held
    by the fullest configuration of lengths that are left.
    """
    n = counts.astype(float)
    index = {int(x): i for i, x in enumerate(lengths)}
    left = _Left(lengths, n, cap)
    amount: dict[tuple[int, ...], float] = {}

    def add(uses: dict[int, int], step: float) -> None:
        config = tuple(int(lengths[j]) for j in sorted(uses, reverse=True) for _ in range(uses[j]))
        amount[config] = amount.get(config, 0.0) + step
        for j, c in uses.items():
            left.left[j] -= c * step

    for r in range(1, rounds + 1):
        floor = n * (1 - r / rounds)  # what may still be left after this round
        weight = np.exp(eta * (np.array(left.left) - floor) / np.maximum(n, 1.0))
        value = lengths * weight
        best, pick = _knapsack(value, lengths, cap)
        worth = value + best[cap - lengths]
        jump, picked = _jumps(pick), pick.tolist()
        least = (1 - slack) * float(worth.max())
        for i in np.argsort(-worth, kind="stable").tolist():
            while (short := left.left[i] - floor[i]) > 1e-6:
                uses = {i: 1}
                if worth[i] >= least:
                    w = jump[cap - int(lengths[i])]
                    while w > 0:
                        j = index[picked[w]]
                        uses[j] = uses.get(j, 0) + 1
                        w = jump[w - picked[w]]
                step = min(left.left[j] / c for j, c in uses.items())
                if len(uses) == 1 or step < min(1.0, short):
                    uses = left.around(i, cap)
                    step = min(left.left[j] / c for j, c in uses.items())
                step = max(min(step, short / uses[i]), 1e-6)
                add(uses, step)
    return amount


def _best_fit(counts: dict[int, int], cap: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit by decreasing length over a histogram, whole counts at a time:
    the pieces of a length go to the fullest open sequences that hold one, then
    to the next fullest, and what is left opens new ones. Sequences of one
    configuration are one entry; an entry is split only where a length ends."""
    open_by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms = np.zeros(cap + 1, dtype=bool)

    def put(room: int, config: tuple[int, ...], k: int) -> None:
        open_by_room.setdefault(room, []).append((config, k))
        rooms[room] = True

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            hit = np.flatnonzero(rooms[length:])
            if len(hit):
                room = length + int(hit[0])
                config, k = open_by_room[room].pop()
                rooms[room] = bool(open_by_room[room])
            else:
                room, config, k = cap, (), -(-left // (cap // length))
            # Piece by piece a sequence would stay the fullest until it is full.
            c = room // length
            whole = min(k, left // c)
            if whole:
                put(room - c * length, config + (length,) * c, whole)
                left -= whole * c
                k -= whole
            if k and left:  # fewer than c pieces are left: one more sequence
                put(room - left * length, config + (length,) * left, 1)
                left, k = 0, k - 1
            if k and config:
                put(room, config, k)
    return [entry for entries in open_by_room.values() for entry in entries]


def plan_packing(histogram: dict[int, int], cap: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(configuration, number of sequences) pairs that hold the histogram
    exactly: full pieces alone, then the rounded program, then best fit."""
    left = {k: v for k, v in histogram.items() if 0 < k < cap and v > 0}
    plan = [((cap,), histogram[cap])] if histogram.get(cap) else []

    def take(amount: dict[tuple[int, ...], float], least: float) -> int:
        """Fullest configurations first; amounts are rounded down."""
        took = 0
        for config, x in sorted(amount.items(), key=lambda kv: (-sum(kv[0]), kv[0])):
            uses = {k: config.count(k) for k in config}
            k = min([int(x + 1e-6), *(left.get(l, 0) // c for l, c in uses.items())])
            if k > 0 and sum(config) >= least:
                plan.append((config, k))
                took += k
                for l, c in uses.items():
                    left[l] -= c * k
        return took

    for solve in range(1, SOLVES + 1):
        if not left:
            break
        lengths = np.array(sorted(left), dtype=np.int64)
        amount = solve_lp(lengths, np.array([left[int(x)] for x in lengths]), cap)
        last = solve == SOLVES or not take(amount, FULL * cap)
        if last:
            take(amount, 0)
        left = {k: v for k, v in left.items() if v}
        if last:
            break
    return plan + _best_fit(left, cap)


def runs_of(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """The plan as sorted runs: pieces of ``length`` with rank in
    [first, first + copies * sequences) lie ``copies`` to a sequence from
    ``sequence`` on, side by side from ``offset``."""
    rows, rank, seq = [], {}, 0
    for config, k in plan:
        offset = 0
        for length in dict.fromkeys(config):
            c = config.count(length)
            rows.append((length, rank.get(length, 0), c, seq, offset))
            rank[length] = rank.get(length, 0) + c * k
            offset += c * length
        seq += k
    rows.sort()
    cols = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "copies", "sequence", "offset"), cols, strict=True))


# ---------------------------------------------------------------- on Spark
PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
          "part int, k long")


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0,
               with_ids: bool = False) -> DataFrame:
    """One row per piece; (part, length, k) numbers the pieces of a task by
    length. Written once by the caller, so a repeated task changes nothing."""
    schema = PIECES + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, enc, end = TaskContext.get().partitionId(), encoder(tokenizer_path), struct.pack("<I", end_id)
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for b in sub_batches(batches):
            rows = []
            for doc_id, ids in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist()), strict=True):
                ids += end
                n = len(ids) // 4
                first = n % capacity or capacity
                edges = [0, *range(first, n + 1, capacity)]
                for p, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
                    body = ids[4 * lo:4 * hi]
                    rows.append((doc_id, p, lo, hi - lo, zlib.crc32(body), part, int(seen[hi - lo]), body))
                    seen[hi - lo] += 1
            cols = list(zip(*rows, strict=True))[:8 if with_ids else 7]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            names = [*(x.split()[0] for x in PIECES.split(", ")), "ids"][:len(cols)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=False)], names=names)

    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0,
         with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and
    ``ids`` when asked for): the place of every piece."""
    pieces = stage(cut_pieces(docs, tokenizer_path, capacity, end_id, with_ids), "pieces")
    spark = pieces.sparkSession
    counts = stage(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {int(r["length"]): int(r["n"]) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(runs_of(plan_packing(histogram, capacity)))
    # Rank among all pieces of a length: those of earlier tasks, then k.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = stage(counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")),
                 "piece-bases")
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("k"))
    keep = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = runs.value
        width = int(r["first"].max()) + 1 if len(r["first"]) else 1
        # One sorted key per run: pieces of a length, then rank.
        starts = r["length"] * np.int64(width) + r["first"]
        for b in batches:
            length, rank = (b.column(x).to_numpy(zero_copy_only=False) for x in ("length", "rank"))
            i = np.searchsorted(starts, length * np.int64(width) + np.minimum(rank, width - 1), side="right") - 1
            by, nth = np.divmod(rank - r["first"][i], r["copies"][i])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(x) for x in keep), pa.array(r["sequence"][i] + by),
                 pa.array(r["offset"][i] + nth * length)], names=[*keep, "sequence_id", "offset"])

    schema = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
              + ("ids binary, " if with_ids else "") + "sequence_id long, offset long")
    return ranked.select(*keep, "rank").mapInArrow(place, schema)
