"""Table sinks and catalog statements.

Managed tables are written with ``saveAsTable`` in Parquet (Delta when its
package is on the class path). Appends match columns by name, as
``saveAsTable`` does, so frames with a different column order append safely.
A table cannot be overwritten from a plan that reads it; write to a new table
or partition instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

DEFAULT_FORMAT = "parquet"
LAYERS = ("bronze", "silver", "gold")


def create_namespaces(spark: SparkSession, names: Sequence[str] = LAYERS,
                      catalog: str | None = None) -> None:
    """CREATE SCHEMA IF NOT EXISTS for each layer."""
    for n in names:
        full = f"{catalog}.{n}" if catalog else n
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {full}")


def show_namespaces(spark: SparkSession, catalog: str | None = None) -> DataFrame:
    """SHOW SCHEMAS [IN catalog]."""
    return spark.sql(f"SHOW SCHEMAS IN {catalog}" if catalog else "SHOW SCHEMAS")


def use_catalog(spark: SparkSession, catalog: str) -> None:
    """USE CATALOG (S8); open-source Spark ships ``spark_catalog`` only."""
    spark.catalog.setCurrentCatalog(catalog)


def current_namespace(spark: SparkSession) -> DataFrame:
    """SELECT current_catalog(), current_schema()."""
    return spark.sql("SELECT current_catalog() AS catalog, current_schema() AS schema")


def write_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = DEFAULT_FORMAT,
                partition_by: Sequence[str] | None = None) -> None:
    """Overwrite (S4) or append (S5) a managed table."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def write_ordered(df: DataFrame, name: str, order: Sequence[str], mode: str = "overwrite") -> None:
    """A managed table in global order (T1): sampled range partitions by
    ``order``, sorted inside, so file k holds rows before those of file k + 1
    and each file's footer statistics are narrow: a filter on the leading
    column skips the other files' row groups."""
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
       .write.mode(mode).format(DEFAULT_FORMAT).saveAsTable(name))


def write_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int,
                   mode: str = "overwrite") -> None:
    """A managed table bucketed and sorted by ``keys``: joins on them read its
    side where it lies, without an exchange. The rows are dealt by bucket first,
    so a bucket is one file."""
    (df.repartition(buckets, *keys).write.mode(mode).format(DEFAULT_FORMAT)
       .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Table scan."""
    return spark.table(name)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet under the session's checkpoint folder and
    return a DataFrame reading it back.

    Used where one intermediate feeds several consumers (bucket counts and
    numbering, block ends and the block scan): Spark plans a DataFrame that is
    used twice as two copies of its whole lineage, so without a written stage
    the source would be scanned and shuffled once per consumer. The folder is
    the shared one named by ``spark.checkpoint.dir`` (set only in local
    sessions), so the files survive the loss of an executor.
    """
    import uuid

    from tidemark.session import ensure_checkpoint_dir

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tidemark-stage/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
