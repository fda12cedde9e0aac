"""Exact top-k search by inner product, columnar branch and bound.

Components become integers, floor(scale * x). Queries and candidates are cut
into blocks; a task gets one block of each and holds the candidates in vertical
layout, one array per dimension. It adds the dimensions block by block. What is
left of a score lies within the product of the norms of the remaining
dimensions, so a candidate whose upper bound is below the k-th best lower bound
is compacted away. Each task hands over k rows a query; the best k of those are
the result. Nothing is approximate.

Defined results: a vector that is null or has a null or non-finite component
takes no part; vectors are compared with those of the same length only; equal
scores go to the smaller id; a row is never its own candidate, a repeated row
is; fewer candidates than k give fewer rows; an empty table gives none; other
columns are ignored. Components so large that a score may not fit a 64-bit
integer end the run with an error.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docledger.session import checkpoint

CELL_SCHEMA = "query_id long, query_row long, vec_id long, row long, score long"
DIMENSIONS_AT_ONCE = 16


def integer_codes(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    vector = F.col(vector_col)
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    too_large = F.raise_error(F.lit("a component is too large for integer scores")).cast("long")

    def code(x: Column) -> Column:
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < float(1 << 62), F.floor(scaled).cast("long")).otherwise(too_large)

    return vectors.where(vector.isNotNull() & F.col(id_col).isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(vector, code).alias("codes")
    )


def _exact_type(queries: np.ndarray, candidates: np.ndarray):
    """The narrowest float in which every partial sum is a whole number, exactly."""
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(candidates).max(initial=0)) * max(1, queries.shape[1])
    if most >= 1 << 63:
        raise OverflowError("a score may not fit a 64-bit integer")
    return np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else np.int64


def best_in_block(queries, query_rows, candidates, ids, rows, k: int):
    """Per query the positions and scores of its k best candidates, own row left out."""
    kind = _exact_type(queries, candidates)
    order = np.argsort(-(candidates.astype(np.float64) ** 2).sum(axis=0), kind="stable")
    vertical = np.ascontiguousarray(candidates[:, order].T.astype(kind))
    asked = queries[:, order].astype(kind)
    dims = vertical.shape[0]
    cuts = list(range(0, dims, DIMENSIONS_AT_ONCE)) + [dims]
    energy = (vertical.astype(np.float64) ** 2).cumsum(axis=0) if dims else np.zeros((1, len(ids)))
    rest = [np.sqrt(np.maximum(energy[-1] - (energy[c - 1] if c else 0), 0)) for c in cuts[1:]]
    for number, query in enumerate(asked):
        wide = query.astype(np.float64) ** 2
        alive = np.flatnonzero(rows != query_rows[number])
        part = np.zeros(len(alive), dtype=kind)
        for step, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False)):
            block = vertical[low:high]
            part = part + query[low:high] @ (block if len(alive) == block.shape[1] else block[:, alive])
            if high == dims or len(alive) <= k:
                continue
            reach = np.sqrt(wide[high:].sum()) * rest[step][alive] * (1 + 1e-6) + 1
            lower = part - reach
            bound = np.partition(lower, len(lower) - k)[len(lower) - k]
            keep = np.flatnonzero(part + reach >= bound)
            if len(keep) < len(alive):
                alive, part = alive[keep], part[keep]
        if len(alive) > k:
            least = np.partition(part, len(part) - k)[len(part) - k]
            keep = np.flatnonzero(part >= least)
            alive, part = alive[keep], part[keep]
        first = np.lexsort((rows[alive], ids[alive], -part))[:k]
        yield alive[first], part[first].astype(np.int64)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1 if n else 0)


def _cell(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {name: [] for name in ("query_id", "query_row", "vec_id", "row", "score")}
        if len(left) and len(right):
            ids, rows = right["vec_id"].to_numpy(), right["row"].to_numpy()
            query_ids, query_rows = left["vec_id"].to_numpy(), left["row"].to_numpy()
            found = best_in_block(_matrix(left["codes"]), query_rows, _matrix(right["codes"]), ids, rows, k)
            for number, (at, scores) in enumerate(found):
                out["query_id"].append(np.full(len(at), query_ids[number]))
                out["query_row"].append(np.full(len(at), query_rows[number]))
                out["vec_id"].append(ids[at])
                out["row"].append(rows[at])
                out["score"].append(scores)
        empty = np.empty(0, dtype=np.int64)
        return pa.table({name: pa.array(np.concatenate(v) if v else empty) for name, v in out.items()})

    return search


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    candidate_rows: int = 16_384,
    query_rows: int = 2_048,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k best rows for every query row.

    ``is_query`` is a condition on the id, named vec_id. Block sizes bound what
    a task holds whatever the table's size; the number of blocks follows it.
    """
    coded = integer_codes(vectors, id_col, vector_col, scale)
    numbered = checkpoint(
        coded.withColumn("row", F.monotonically_increasing_id()).withColumn("dims", F.size("codes"))
    )
    total = numbered.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    blocks, query_blocks = max(1, ceil(total["n"] / candidate_rows)), max(1, ceil(total["q"] / query_rows))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    query_block = F.pmod(F.xxhash64("row"), F.lit(query_blocks)).cast("int")
    candidates = numbered.select(
        "vec_id", "row", "codes", "dims", block.alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"),
    )
    queries = numbered.where(is_query).select(
        "vec_id", "row", "codes", "dims", query_block.alias("query_block"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    cell = ["dims", "query_block", "block"]
    found = queries.groupBy(*cell).cogroup(candidates.groupBy(*cell)).applyInArrow(_cell(k), CELL_SCHEMA)
    ranked = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (
        found.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
