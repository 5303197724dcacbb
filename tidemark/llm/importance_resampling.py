"""Target-distribution importance resampling on hashed n-grams.

Words. A table of 256 bytes lower-cases A-Z and blanks every separator byte of
the UTF-8 text; ``bytes.split`` gives the words. Bytes from 128 on are word
bytes, so no character is cut.

Features. All runs of 1 to 3 consecutive words. The crc32 of a run is the
crc32 of a space and its last word, seeded with the crc32 of the run without
it, so each run costs one call. Buckets are crc32 modulo ``BUCKETS``.

Weights. Counters hold the corpus' buckets, one per task, reduced by a grouped
sum to at most ``BUCKETS`` rows; the target's likewise. A bucket's gain is
floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))); a document's weight is the sum of
the gains of its features.

Draw. Weights get Gumbel noise from a hash of seed and doc_id, so the highest
scores are a draw without replacement in proportion to exp(weight / 1000). The
scores are ranked over a sampled range partitioning, by score descending and
doc_id ascending: no task holds more than its range, and rows of one score or
one id are split by their place in the table.

Defined cases: a null text has no words; a text without features has weight 0
and can be drawn only if ``least_words`` is 0; a null doc_id hashes as the text
``null`` and ranks after equal scores; repeated rows are documents of their
own; an empty target gives gains by the corpus alone; an empty corpus gives no
rows; other columns are not read. Long texts are cut at word ends into chunks,
runs carried over, so a task's memory follows the chunk, not the text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage
from tidemark.operators.positions import POS
from tidemark.operators.ranges import with_range_position

BUCKETS = 10_000
RUN = 3
CHUNK = 1 << 20

_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_LOWER = {b: b + 32 for b in range(0x41, 0x5B)}
#: Each byte as a word byte in lower case, or a space.
TRANSLATE = bytes(x if (x := _LOWER.get(b, b)) in _WORD else 0x20 for b in range(256))


def word_chunks(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text in lists of about a chunk, in order."""
    blanked = (text or "").encode("utf-8", "replace").translate(TRANSLATE)
    at = 0
    while at < len(blanked):
        end = blanked.find(b" ", at + CHUNK)
        end = len(blanked) if end < 0 else end
        yield blanked[at:end].split()
        at = end


def run_hashes(words: list[bytes], carried: list[bytes]) -> list[int]:
    """crc32 of every run of 1 to RUN words that ends in ``words``;
    ``carried``: the RUN - 1 words before them (fewer at a text's start)."""
    if not words:
        return []
    known = len(carried)
    every = carried + words
    spaced = [b" " + w for w in every]
    seeds = list(map(crc32, every))       # of runs of one word, by first word
    out = seeds[known:]
    for n in range(1, RUN):
        # One word longer: a run that starts at i now ends at i + n.
        seeds = list(map(crc32, spaced[n:], seeds))
        out += seeds[max(0, known - n):]
    return out


def features(text: str | None) -> tuple[int, list[np.ndarray]]:
    """Number of words and the buckets of all runs, chunk by chunk."""
    n, carried, out = 0, [], []
    for words in word_chunks(text):
        n += len(words)
        out.append(np.array(run_hashes(words, carried), dtype=np.uint32) % np.uint32(BUCKETS))
        carried = (carried + words)[1 - RUN:]
    return n, out


def bucket_counts(texts: DataFrame) -> DataFrame:
    """bucket, n: features of all whole texts. One Counter per task, summed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[int] = Counter()
        for b in batches:
            for text in b.column(0):
                for buckets in features(text.as_py())[1]:
                    counts.update(buckets.tolist())
        yield pa.RecordBatch.from_pydict({
            "bucket": pa.array(list(counts.keys()), pa.int32()), "n": pa.array(list(counts.values()), pa.int64())})

    return texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: dict[int, int], target: dict[int, int]) -> np.ndarray:
    """Gain of each bucket, from the counts in the corpus and in the target."""
    s_all, t_all = float(sum(corpus.values()) + BUCKETS), float(sum(target.values()) + BUCKETS)
    return np.array([
        math.floor(1000 * math.log((target.get(b, 0) + 1.0) * s_all / ((corpus.get(b, 0) + 1.0) * t_all)))
        for b in range(BUCKETS)], dtype=np.int64)


def _held(counts: DataFrame) -> dict[int, int]:
    """Counts at the driver: at most BUCKETS rows."""
    t = counts.toArrow()
    return dict(zip(t.column("bucket").to_pylist(), t.column("n").to_pylist(), strict=True))


def noise(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln(u))), u from the first 32 bits of a keyed SHA-256."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight of every whole text; one narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # BUCKETS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        for b in batches:
            rows = []
            for text in b.column(1):
                words, parts = features(text.as_py())
                rows.append((words, sum(map(len, parts)), sum(int(g[p].sum()) for p in parts)))
            cols = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in cols)],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every document; of
    those with at least ``least_words`` words, the ``percent`` % with the
    highest scores are drawn and ranked from 1, the others have no rank."""
    gain = gains(_held(bucket_counts(docs)), _held(bucket_counts(target)))
    scored = weigh(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = stage(scored, "resample-scores")  # three readers
    fit = F.col("n_words") >= least_words
    draw = scored.where(fit).count() * percent // 100
    placed = with_range_position(
        scored.where(fit), [], [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], with_length=False, tiebreak=True)
    rank = F.when(F.col(POS) < draw, F.col(POS) + 1).cast("long")
    return placed.select(*scored.columns, rank.alias("rank")).unionByName(
        scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))
