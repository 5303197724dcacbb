"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.sinks import stage

__all__ = ["stage", "shared_path", "table", "sub_batches", "doc_crc", "bounded_sample", "heavy_join"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the folder that driver and executors share."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tidemark-llm/{label}-{uuid.uuid4().hex}"


def sub_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``rows`` rows: what a task holds in Python objects at
    once does not follow the Arrow batch size. Slices share their buffers."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def doc_crc(col: str = "doc_id"):
    """crc32 of the id's decimal text, as the train / held-out splits use it."""
    return F.crc32(F.col(col).cast("string"))


def bounded_sample(df: DataFrame, key: str, bound: int) -> DataFrame:
    """About ``bound`` distinct rows chosen by a hash of ``key``: all distinct
    rows when there are no more than that. Repeats count once, so however often
    a key occurs, the rows chosen stay few. The choice is the same on every run
    and does not depend on partitioning."""
    df = df.distinct()
    n = df.count()
    if n <= bound:
        return df
    cut = int(bound / n * (1 << 30))
    return df.where(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) < cut)


def heavy_join(rows: DataFrame, facts: DataFrame, key: str, copies: str, heavy: int) -> DataFrame:
    """rows with the facts of their key (left join); facts hold one row a key
    and in ``copies`` how many rows have it. Keys of more than 1 / ``heavy`` of
    all rows are fewer than ``heavy``: their facts are broadcast, so no hot key
    is shuffled; the others meet by a shuffle join. Rows without a key stay
    where they are."""
    total = facts.agg(F.sum(copies)).first()[0] or 0
    hot = F.col(copies) > total / heavy
    often = facts.where(hot).drop(copies)
    rest = rows.join(F.broadcast(often.select(key)), key, "left_anti")
    light = rest.where(F.col(key).isNotNull()).join(facts.where(~hot).drop(copies).hint("merge"), key, "left")
    none = rest.where(F.col(key).isNull())
    return (rows.join(F.broadcast(often), key).unionByName(light)
            .unionByName(none, allowMissingColumns=True))
