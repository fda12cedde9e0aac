"""Hard negatives by threshold joins over an inverted index with suffix-norm bounds.

Components become integers, floor(scale * x). Anchors and candidates meet in
cells, a block of each, so a task's size doesn't follow the table's. In a cell
the candidates are indexed for a threshold join: dimensions stand in order of
energy, and a candidate enters the lists of its leading dimensions only, up to
where the norm of its remaining ones times the largest remaining norm of an
anchor, over that anchor's threshold, falls below one: what is left can't reach
the threshold alone. Candidates are ordered by how many lists hold them, so a
list is a prefix of a column and partial scores add up as products of prefixes.
A pair goes on if its partial score and the product of the norms left reach the
threshold; its remaining dimensions are then added group by group under the same
bound. The score of a pair that comes through is exact.

Every anchor has score windows to fill with ``k`` rows. Its threshold starts high
and is lowered until its windows are full or the threshold is at their foot, and
only anchors with open windows are joined again. First the window is everything
among rows of the anchor's label, which gives its positives; then each positive
opens a window among rows of other labels, which gives its negatives.

Defined results: a row with a null label or a vector that is null or has a null
or non-finite component takes no part; vectors meet those of their own length
only; equal scores go to the smaller id, null ids last; a row is never its own
positive, a repeated row is; a window without rows, such as that of a negative
score, gives none; an empty table gives none; other columns are ignored. A score
that no long can hold ends the run with an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, inf

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docledger.session import checkpoint

POSITIVES = 5
NEGATIVES = 10
WINDOW_PERCENT = (30, 90)
GROUP = 8  # dimensions that share a list length
START, LOWER = 0.9, 0.75  # of a window's head, and of the threshold before
SMALLEST = 0.05  # of the largest score that norms allow; below it the threshold goes to the foot
CANDIDATE_ROWS = 16_384
ANCHOR_ROWS = 256
_SLACK = 1e-9

FOUND = "anchor_row long, anchor_id long, place int, positive_id long, positive_score long, row long, vec_id long, score long"


def coded_vectors(rows: DataFrame, label: Column, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, label, codes, dims and row of the rows that take part, as a table in the shared folder."""
    vector = rows[f"`{vector_col}`"]
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(inf)))
    large = F.raise_error(F.lit("a component is too large for integer scores"))

    def code(x: Column) -> Column:
        scaled = F.floor(x.cast("double") * scale)
        return F.when(F.abs(x.cast("double") * scale) < float(1 << 62), scaled).otherwise(large.cast("long")).cast("long")

    kept = rows.where(vector.isNotNull() & finite & label.isNotNull())
    return checkpoint(
        kept.select(
            rows[f"`{id_col}`"].cast("long").alias("vec_id"),
            label.alias("label"),
            F.transform(vector, code).alias("codes"),
            F.size(vector).alias("dims"),
            F.monotonically_increasing_id().alias("row"),
        )
    )


@dataclass(frozen=True)
class Vectors:
    """Rows of one block in numpy; ``values`` in a type in which every sum of products is exact."""

    ids: np.ndarray
    has_id: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    values: np.ndarray


def exact_type(anchors: np.ndarray, candidates: np.ndarray) -> type:
    most = int(np.abs(anchors).max(initial=0)) * int(np.abs(candidates).max(initial=0)) * max(1, anchors.shape[1])
    if most >= 1 << 63:
        raise OverflowError("a score may not fit a 64-bit integer")
    return np.float64 if most < 1 << 53 else np.int64


def _norms_left(values: np.ndarray, edges: list[int]) -> np.ndarray:
    """Norm of every row from each edge on, a little above the exact one."""
    squares = values.astype(np.float64) ** 2
    sums = [squares[:, a:b].sum(axis=1) for a, b in zip(edges, edges[1:], strict=False)]
    left = np.zeros((len(values), len(edges)))
    for i in range(len(sums) - 1, -1, -1):
        left[:, i] = left[:, i + 1] + sums[i]
    return np.sqrt(left) * (1 + _SLACK)


class ThresholdJoin:
    """Anchors against candidates; ``pairs`` gives all pairs that reach their anchor's threshold."""

    def __init__(self, anchors: np.ndarray, candidates: np.ndarray):
        kind = exact_type(anchors, candidates)
        order = np.argsort(-(candidates.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.anchors = anchors[:, order].astype(kind)
        self.candidates = candidates[:, order].astype(kind)
        dims = candidates.shape[1]
        self.edges = [*range(0, dims, GROUP), dims]
        self.anchor_left = _norms_left(self.anchors, self.edges)
        self.candidate_left = _norms_left(self.candidates, self.edges)

    def pairs(self, asked: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, candidate and score of every pair at or above the threshold of the anchor."""
        parts = [
            self._join(asked[pick], thresholds[pick], bounded)
            for bounded, pick in ((True, thresholds > 0), (False, thresholds <= 0))
            if pick.any()
        ]
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _join(self, asked: np.ndarray, thresholds: np.ndarray, bounded: bool):
        edges, steps = self.edges, len(self.edges) - 1
        left = self.anchor_left[asked]
        if bounded:
            reach = (left / thresholds[:, None]).max(axis=0)
            lists = (self.candidate_left[:, :steps] * reach[:steps] * (1 + _SLACK) >= 1).sum(axis=1)
        else:
            lists = np.full(len(self.candidates), steps)
        order = np.argsort(-lists, kind="stable")
        order = order[: int((lists > 0).sum())] if steps else order
        lists = lists[order]
        lengths = [int((lists > g).sum()) for g in range(steps)]
        scores = np.zeros((len(asked), len(order)), dtype=self.anchors.dtype)
        for g, n in enumerate(lengths):
            if n:
                low, high = edges[g], edges[g + 1]
                scores[:, :n] += self.anchors[asked, low:high] @ self.candidates[order[:n], low:high].T
        rest = self.candidate_left[order, lists]
        if bounded:
            ai, ci = np.nonzero(scores + left[:, lists] * rest * (1 + _SLACK) + _SLACK >= thresholds[:, None])
        else:
            ai, ci = (x.ravel() for x in np.indices(scores.shape))
        found = scores[ai, ci]
        for g in range(steps):
            open_ = np.flatnonzero(lists[ci] <= g)
            if not len(open_):
                continue
            low, high = edges[g], edges[g + 1]
            a, c = asked[ai[open_]], order[ci[open_]]
            found[open_] += (self.anchors[a, low:high] * self.candidates[c, low:high]).sum(axis=1)
            reached = found[open_] + self.anchor_left[a, g + 1] * self.candidate_left[c, g + 1] + _SLACK
            gone = open_[reached < thresholds[ai[open_]]]
            if len(gone):
                keep = np.ones(len(ai), dtype=bool)
                keep[gone] = False
                ai, ci, found = ai[keep], ci[keep], found[keep]
        whole = np.flatnonzero(found >= thresholds[ai])
        return asked[ai[whole]], order[ci[whole]], found[whole].astype(np.int64)


Window = tuple[float, float]


def fill_windows(
    join: ThresholdJoin,
    windows: list[list[Window]],
    allowed: Callable[[np.ndarray, np.ndarray], np.ndarray],
    first: Callable[[np.ndarray, np.ndarray], np.ndarray],
    k: int,
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Anchor, number of its window, and the first ``k`` candidates in it with their scores.

    Thresholds start below the head of an anchor's lowest window and fall until
    all its windows hold ``k`` allowed candidates or its lowest foot is reached.
    """
    asked = np.array([i for i, own in enumerate(windows) if own], dtype=np.int64)
    if not len(asked) or not len(join.candidates):
        return
    largest = join.anchor_left[:, 0] * join.candidate_left[:, 0].max()
    foot = np.array([min(low for low, _ in windows[i]) for i in asked])
    head = np.array([min(high for _, high in windows[i]) for i in asked])
    level = START * np.minimum(head, largest[asked])
    while len(asked):
        level = np.where((level <= foot) | (level <= SMALLEST * largest[asked]), foot, level)
        ai, ci, scores = join.pairs(asked, level)
        fit = allowed(ai, ci)
        ai, ci, scores = ai[fit], ci[fit], scores[fit]
        order = np.argsort(ai, kind="stable")
        ai, ci, scores = ai[order], ci[order], scores[order]
        starts, ends = np.searchsorted(ai, asked), np.searchsorted(ai, asked, side="right")
        open_ = []
        for n, i in enumerate(asked.tolist()):
            c, s = ci[starts[n] : ends[n]], scores[starts[n] : ends[n]]
            inside = [np.flatnonzero((s >= low) & (s <= high)) for low, high in windows[i]]
            if level[n] > foot[n] and any(len(x) < k for x in inside):
                open_.append(n)
                continue
            for number, x in enumerate(inside):
                if len(x) > k:
                    least = np.partition(s[x], len(x) - k)[len(x) - k]
                    x = x[s[x] >= least]
                x = x[first(c[x], s[x])][:k]
                yield i, number, c[x], s[x]
        asked, level, foot = asked[open_], level[open_] * LOWER, foot[open_]


def _vectors(table: pa.Table) -> Vectors:
    ids, codes = table["vec_id"], table["codes"].combine_chunks()
    n = len(table)
    return Vectors(
        ids.fill_null(0).to_numpy(),
        ids.is_valid().to_numpy(),
        table["row"].to_numpy(),
        table["label"].to_numpy(),
        codes.flatten().to_numpy(zero_copy_only=False).reshape(n, -1 if n and len(codes.flatten()) else 0),
    )


def score_window(score: int, percent: tuple[int, int]) -> Window | None:
    """Least and most whole scores between the two percentages of ``score``."""
    low, high = -(-percent[0] * score // 100), percent[1] * score // 100
    return (low, high) if low <= high else None


def _cell(k: int, percent: tuple[int, int] | None):
    """One cell: among rows of the anchor's label without ``percent``, else of other labels inside the windows."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {name.split()[0]: [] for name in FOUND.split(", ")}
        if len(left) and len(right):
            anchors, candidates = _vectors(left), _vectors(right)
            told = [[]] * len(left) if percent is None else left["positives"].to_pylist()
            for n in range(len(left)) if percent is None else ():
                told[n] = [None]
            windows = [[(-inf, inf)] if p == [None] else [w for w in (score_window(x["score"], percent) for x in p) if w] for p in told]
            places = [[j for j, x in enumerate(p) if x is None or score_window(x["score"], percent)] for p in told]
            for picked in _label_groups(anchors, candidates, percent is None):
                mine, theirs = picked
                join = ThresholdJoin(anchors.values[mine], candidates.values[theirs])

                def allowed(a, c, mine=mine, theirs=theirs):
                    if percent is None:
                        return anchors.rows[mine[a]] != candidates.rows[theirs[c]]
                    return anchors.labels[mine[a]] != candidates.labels[theirs[c]]

                def first(c, s, theirs=theirs):
                    at = theirs[c]
                    return np.lexsort((candidates.rows[at], candidates.ids[at], ~candidates.has_id[at], -s))

                for i, number, c, s in fill_windows(join, [windows[m] for m in mine], allowed, first, k):
                    anchor, at = mine[i], theirs[c]
                    place = places[anchor][number]
                    positive = told[anchor][place] or {"vec_id": None, "score": None}
                    for j, score in zip(at.tolist(), s.tolist(), strict=True):
                        out["anchor_row"].append(int(anchors.rows[anchor]))
                        out["anchor_id"].append(int(anchors.ids[anchor]) if anchors.has_id[anchor] else None)
                        out["place"].append(place)
                        out["positive_id"].append(positive["vec_id"])
                        out["positive_score"].append(positive["score"])
                        out["row"].append(int(candidates.rows[j]))
                        out["vec_id"].append(int(candidates.ids[j]) if candidates.has_id[j] else None)
                        out["score"].append(score)
        kinds = {"place": pa.int32()}
        return pa.table({name: pa.array(values, kinds.get(name, pa.int64())) for name, values in out.items()})

    return search


def _label_groups(anchors: Vectors, candidates: Vectors, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Which anchors meet which candidates: those of their own label, or all at once."""
    if not same:
        yield np.arange(len(anchors.ids)), np.arange(len(candidates.ids))
        return
    for label in np.unique(anchors.labels):
        theirs = np.flatnonzero(candidates.labels == label)
        if len(theirs):
            yield np.flatnonzero(anchors.labels == label), theirs


def _searched(anchors: DataFrame, vectors: DataFrame, counts: tuple[int, int], k: int, percent: tuple[int, int] | None) -> DataFrame:
    """The ``k`` first rows of every anchor's windows; cells hand over k rows a window, merged here."""
    anchor_blocks, blocks = counts

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    extra = [] if percent is None else ["positives"]
    columns = ["vec_id", "label", "codes", "dims", "row"]
    left = anchors.select(*columns, *extra, block(anchor_blocks).alias("anchor_block"), each(blocks).alias("block"))
    # Columns of the right side are renamed to themselves: the two sides come from one table, and shared ones would be lost.
    own = [F.col(c).alias(c) for c in columns]
    right = vectors.select(*own, block(blocks).alias("block"), each(anchor_blocks).alias("anchor_block"))
    cell = ["dims", "anchor_block", "block"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_cell(k, percent), FOUND)
    ranked = W.partitionBy("anchor_row", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    label: Column,
    scale: int = 256,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: tuple[int, int] = WINDOW_PERCENT,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    candidate_rows: int = CANDIDATE_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on the id, named vec_id; ``label`` an expression
    of the table's columns. An anchor's positives are its ``positives`` best rows
    of its label; the negatives of each are the best rows of other labels with a
    score between the two percentages of the positive's.
    """
    vectors = coded_vectors(rows, label, scale, id_col, vector_col)
    total = vectors.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_anchor, 1)).alias("a")).first()
    counts = max(1, ceil(total["a"] / anchor_rows)), max(1, ceil(total["n"] / candidate_rows))
    anchors = vectors.where(is_anchor)
    best = _searched(anchors, vectors, counts, positives, None)
    listed = best.groupBy("anchor_row").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))), lambda p: F.struct(p["vec_id"].alias("vec_id"), p["score"].alias("score"))).alias("positives")
    )
    told = checkpoint(anchors.join(listed, anchors["row"] == listed["anchor_row"]).drop("anchor_row"))
    return _searched(told, vectors, counts, negatives, percent).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
