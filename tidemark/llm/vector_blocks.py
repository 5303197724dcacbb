"""A stated query set against all rows, in blocks, for the two vector searches.

Rows and queries are dealt by a hash into blocks of bounded size (rows by
their id and place in the table, so that a repeated id is spread); each task
gets one block of queries and one of rows, searches it, and hands back the few
best per query, which one ranking per query merges. No vector is broadcast or
collected. Rows are copied once per block of queries and queries once per
block of rows, so both block sizes are parameters.

Vectors that are null, empty, or hold null or non-finite components take no
part; vectors of different lengths are searched apart from each other.
Repeated vec_ids: one of the rows is the query, every row of another id is a
candidate. Null vec_ids take no part.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS, QUERIES = 16_384, 4_096


def usable(vectors: DataFrame, zero: bool = True) -> DataFrame:
    """(vec_id, v): v as doubles, of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine)
    if not zero:
        rows = rows.where(F.exists(v, lambda x: x != 0))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def search(rows: DataFrame, is_query: Column, k: int,
           nearest: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple],
           score: str, ascending: bool, block_rows: int = ROWS, block_queries: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of all blocks, ties
    to the smaller vec_id. ``nearest(query ids, queries, row ids, rows)``
    returns three arrays: query position, row position, score."""
    queries = rows.where(is_query).dropDuplicates(["vec_id"])
    n, q = rows.count(), queries.count()
    nb, nq = max(1, math.ceil(n / block_rows)), max(1, math.ceil(q / block_queries))

    def dealt(df: DataFrame, own: str, parts: int, other: str, others: int, *salt: Column) -> DataFrame:
        return df.select("vec_id", "v", F.size("v").alias("dim"),
                         F.pmod(F.xxhash64("vec_id", F.lit(own), *salt), F.lit(parts)).cast("int").alias(own),
                         F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    a = dealt(queries, "qb", nq, "rb", nb).groupBy("dim", "qb", "rb")
    b = dealt(rows, "rb", nb, "qb", nq, F.monotonically_increasing_id()).groupBy("dim", "qb", "rb")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows and right.num_rows:
            qid, rid = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
            i, j, s = nearest(qid, matrix(left.column("v")), rid, matrix(right.column("v")))
            return pa.table({"query_id": pa.array(qid[i]), "vec_id": pa.array(rid[j]), "score": pa.array(s)})
        return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                         "score": pa.array([], pa.int64() if score == "long" else pa.float64())})

    found = a.cogroup(b).applyInArrow(run, f"query_id long, vec_id long, score {score}")
    by = F.col("score").asc() if ascending else F.col("score").desc()
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(by, "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
