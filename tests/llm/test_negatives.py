import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from docledger.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score string, dims string"


def narrowed(v):
    return v if v is None else [x if x is None else struct.unpack("f", struct.pack("f", x))[0] for x in v]


def brute(rows, scale=256, positives=5, limit=10, percent=(30, 90), every=100):
    coded = []
    for place, (i, v, label) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        coded.append((place, i, [math.floor(scale * x) for x in v], label))
    out = []
    for p, i, q, label in coded:
        if i is None or i % every:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(q, c, strict=True)), j is None, j or 0, other)
            for r, j, c, other in coded
            if r != p and len(c) == len(q)
        )
        for s, missing, j, _ in [x for x in scored if x[3] == label][:positives]:
            inside = [x for x in scored if x[3] != label and percent[0] * -s <= 100 * -x[0] <= percent[1] * -s]
            out += [
                (i, None if missing else j, rank, None if x[1] else x[2], -s, -x[0]) for rank, x in enumerate(inside[:limit], 1)
            ]
    return sorted(out, key=str)


def found(spark, rows, kind=SCHEMA, **settings):
    table = spark.createDataFrame([(i, v, label, "x", "y", "z") for i, v, label in rows], kind).repartition(4)
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    mined = negatives.hard_negatives(table, F.col("vec_id") % 100 == 0, noisy, **settings)
    return sorted(map(tuple, mined.collect()), key=str)


def vectors(seed, n, dims=24, spread=0.6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.2) for _ in range(dims)] for _ in range(4)]
    rows = []
    for i in range(n):
        label = rng.randrange(4)
        rows.append((i * 20, [c + spread * rng.gauss(0, 0.2) for c in centres[label]], label))
    return rows


@pytest.mark.parametrize("blocks", [{}, {"candidate_rows": 40, "anchor_rows": 7}])
def test_matches_brute_force_in_any_blocks(spark, blocks):
    rows = vectors(1, 400)
    rows += [(100, rows[5][1], 2), (9_000, None, 1), (9_100, rows[1][1], None), (9_200, [None] * 24, 1), (9_300, [float("nan")] * 24, 1)]
    rows += [(9_400, [0.0] * 24, 1), (9_500, [0.5] * 7, 1), (9_501, [0.4] * 7, 1), (9_502, [0.3] * 7, 2), (None, rows[8][1], 3), (9_600, [], 1)]
    rows += [(10_001 + i, [0.25] * 24, 3) for i in range(40)]
    rows = [(i, narrowed(v), label) for i, v, label in rows]
    expected = brute(rows)
    assert len(expected) > 200
    assert found(spark, rows, **blocks) == expected


def test_other_windows(spark):
    rows = [(i, narrowed(v), label) for i, v, label in vectors(2, 200, dims=5)]
    settings = {"scale": 64, "positives": 3, "percent": (-50, 110)}
    assert found(spark, rows, negatives=4, **settings) == brute(rows, limit=4, **settings)


def test_scores_beyond_doubles_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i * 25, [rng.uniform(-2e6, 3e6) for _ in range(9)], rng.randrange(3)) for i in range(60)]
    assert found(spark, rows, SCHEMA.replace("array<float>", "array<double>")) == brute(rows)


@pytest.mark.parametrize("size", [1e10, 1e300])
def test_scores_that_no_long_holds_are_an_error(spark, size):
    rows = [(i * 100, [size, size / 2], i % 2) for i in range(6)]
    with pytest.raises(Exception, match="(?i)64-bit|too large"):
        found(spark, rows, SCHEMA.replace("array<float>", "array<double>"))


def test_threshold_join_is_exact_and_its_index_omits_dimensions():
    rng = np.random.default_rng(4)
    weights = np.geomspace(1, 0.02, 48)
    anchors = np.floor(256 * rng.normal(size=(12, 48)) * weights).astype(np.int64)
    candidates = np.floor(256 * rng.normal(size=(500, 48)) * weights).astype(np.int64)
    join = negatives.ThresholdJoin(anchors, candidates)
    scores = anchors @ candidates.T
    asked = np.array([0, 3, 4, 11])
    for share in (0.99, 0.9, 0.5, 0.01):
        thresholds = np.quantile(scores[asked], share, axis=1)
        a, c, s = join.pairs(asked, thresholds)
        expected = [(i, j, scores[i, j]) for i, t in zip(asked, thresholds, strict=True) for j in range(500) if scores[i, j] >= t]
        assert sorted(zip(a.tolist(), c.tolist(), s.tolist(), strict=True)) == sorted((int(i), j, int(x)) for i, j, x in expected)


def test_empty_and_single(spark):
    assert found(spark, [(0, None, 1)]) == []
    assert found(spark, [(0, [0.5, 0.5], 1)]) == []
    assert found(spark, [(0, [0.5, 0.5], 1), (1, [0.5, 0.5], 1)]) == []
