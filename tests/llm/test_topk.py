import math
import random

import pytest
from pyspark.sql import functions as F

from docledger.llm import topk


def brute(rows, k=20, every=20):
    coded = []
    for place, (i, v) in enumerate(rows):
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        coded.append((place, i, [math.floor(64 * x) for x in v]))
    out = []
    for p, i, q in coded:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, c, strict=True)), j) for r, j, c in coded if r != p and len(c) == len(q))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_matches_brute_force_in_any_blocks(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(24)]) for i in range(400)]
    rows += [(20, rows[20][1]), (500, None), (520, [None] * 24), (540, [float("nan")] * 24), (560, [float("inf")] * 24)]
    rows += [(600 + i, [0.5] * 24) for i in range(60)] + [(700, [1.0] * 5), (701, [-1.0] * 5), (None, [0.1] * 24), (720, [])]
    vectors = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    import struct

    narrowed = [(i, v if v is None else [x if x is None else struct.unpack("f", struct.pack("f", x))[0] for x in v]) for i, v in rows]
    for candidates, queries in ((16_384, 2_048), (50, 7)):
        found = topk.exact_top_k(vectors, F.col("vec_id") % 20 == 0, candidate_rows=candidates, query_rows=queries)
        assert sorted(tuple(r) for r in found.collect()) == brute(narrowed)


def test_large_components_stay_exact(spark):
    rng = random.Random(5)
    rows = [(i, [rng.uniform(-1e6, 1e6) for _ in range(20)]) for i in range(80)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.exact_top_k(vectors, F.col("vec_id") % 20 == 0)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


@pytest.mark.parametrize("size", [1e10, 1e300])
def test_scores_that_no_long_holds_are_an_error(spark, size):
    vectors = spark.createDataFrame([(i * 20, [size, size / 3]) for i in range(4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64-bit|too large"):
        topk.exact_top_k(vectors, F.col("vec_id") % 20 == 0).collect()


def test_empty(spark):
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.exact_top_k(vectors, F.col("vec_id") % 20 == 0).collect() == []
