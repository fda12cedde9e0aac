"""Merkle manifest of a dataset with a proof for every row, by time-forward processing.

A leaf is the digest of a row's fields. The leaves of a tree (one per source)
stand in the order of their ids; every ``FAN`` consecutive nodes become one, the
last run may be shorter, until one is left. The trees' roots, in order of their
sources, are the leaves of one more tree whose root stands for the dataset.

A node is labelled by its last leaf and its level, so children come before their
parents. Going forward, a node's digest is sent to its parent's label through a
priority queue; the parent is worked on when its label is least. The queue's
external part is the shuffle: leaves arrive sorted by label, and what goes to a
label of another task is a row of the next layer. The in-task part is a heap that
holds no more messages than a path to the root has runs. Then the labels are
swept in reverse: a parent, having the proof of its own way to the root, sends
each child that proof with the child's siblings put before it, until the leaves
have theirs. A task works on blocks of ``FAN ** LEVELS`` nodes of a tree, however
large the tree; a layer has that many times fewer rows than the one below.

A proof lists, from the leaf to the root, the digests left and right of the way,
so folding a leaf with it is a plain expression and needs nothing else.

Defined results: a null field is told apart from every value; a null id stands
first, rows with equal ids by their leaf; rows with a null source form a tree,
the first; a node alone in its run is hashed alone; a lone leaf is its tree's
root; an empty table has no rows; further columns are ignored unless named.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping, Sequence
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docledger.operators.ordering import with_position
from docledger.session import checkpoint

FAN = 3
LEVELS = 7  # of a tree, in one task: 2,187 nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PROOF = "array<struct<left:string,right:string>>"
_ARROW_PROOF = pa.struct([("left", pa.string()), ("right", pa.string())])
ROWS_OUT = 1_000


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: per field its UTF-8 byte count, ``:`` and its text, or ``-`` for null."""
    told = [
        F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-"))
        for f in fields
    ]
    return F.sha2(F.concat(*told), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf leads to by its proof."""
    return F.aggregate(proof, leaf, lambda at, step: F.sha2(F.concat(step["left"], at, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings on the way, left to right, level by level."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _hash(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode("ascii")).hexdigest()


class Block:
    """Consecutive nodes of one layer of a tree of ``size`` nodes and all nodes above them, up to ``LEVELS``."""

    def __init__(self, first: int, size: int, fan: int, levels: int):
        self.first, self.fan, self.size = first, fan, size
        self.sizes = [size]
        while self.sizes[-1] > 1 and len(self.sizes) <= levels:
            self.sizes.append(-(-self.sizes[-1] // fan))
        self.top = len(self.sizes) - 1
        self.digests: dict[tuple[int, int], str] = {}

    def label(self, level: int, node: int) -> tuple[int, int]:
        return min((node + 1) * self.fan**level, self.size) - 1, level

    def forward(self, leaves: Sequence[str], keep: bool) -> str:
        """Digest of the block's highest node; with ``keep`` those of all its nodes are held for the way back."""
        queue: list[tuple[int, int, int, int, str]] = []

        def send(level: int, node: int, digest: str) -> str | None:
            if keep:
                self.digests[level, node] = digest
            if level == self.top:
                return digest
            up = node // self.fan
            heappush(queue, (*self.label(level + 1, up), up, node, digest))
            return None

        found = None
        for place, leaf in enumerate(leaves, self.first):
            found = send(0, place, leaf)
            while queue and queue[0][0] <= place:
                _, level, node, _, digest = heappop(queue)
                run = [digest]
                while queue and queue[0][1] == level and queue[0][2] == node:
                    run.append(heappop(queue)[4])
                found = send(level, node, _hash(run))
        return found

    def reverse(self, proof: tuple | None) -> Iterator[tuple[int, tuple | None]]:
        """Every leaf of the block with its proof, from the last to the first; ``proof`` is that of the highest node."""
        queue: list[tuple[int, int, int, tuple | None]] = []

        def send(level: int, node: int, way: tuple | None) -> None:
            last, of = self.label(level, node)
            heappush(queue, (-last, -of, node, way))

        send(self.top, self.first // self.fan**self.top, proof)
        while queue:
            _, minus, node, way = heappop(queue)
            level = -minus
            if level == 0:
                yield node, way
                continue
            low = node * self.fan
            run = range(low, min(low + self.fan, self.sizes[level - 1]))
            held = [self.digests[level - 1, child] for child in run]
            for i, child in enumerate(run):
                send(level - 1, child, ("".join(held[:i]), "".join(held[i + 1 :]), way))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns], strict=True)


def _up(fan: int, levels: int) -> Callable:
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (tree, block), rows in groupby(_rows(batches), key=lambda r: r[:2]):
            _, _, first, size, digest = next(rows)
            nodes = Block(first, size, fan, levels)
            top = nodes.forward([digest, *(r[4] for r in rows)], keep=False)
            out.append((tree, block, nodes.sizes[-1], top))
            if len(out) >= ROWS_OUT:
                yield _node_batch(out)
                out = []
        if out:
            yield _node_batch(out)

    return sweep


def _node_batch(rows: list[tuple]) -> pa.RecordBatch:
    tree, idx, size, digest = zip(*rows, strict=True)
    return pa.RecordBatch.from_pydict(
        {
            "tree": pa.array(tree, pa.string()),
            "idx": pa.array(idx, pa.int64()),
            "size": pa.array(size, pa.int64()),
            "digest": pa.array(digest, pa.string()),
        }
    )


def _down(fan: int, levels: int, carried: Sequence[tuple[str, pa.DataType]]) -> Callable:
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (tree, _), rows in groupby(_rows(batches), key=lambda r: r[:2]):
            message = next(rows)
            proof = None
            for step in reversed(message[6]):
                proof = (step["left"], step["right"], proof)
            nodes = list(rows)
            first, size = nodes[0][3], nodes[0][4]
            block = Block(first, size, fan, levels)
            block.forward([r[5] for r in nodes], keep=True)
            for place, way in block.reverse(proof):
                row = nodes[place - first]
                out.append((tree, place, row[5], message[5], way, *row[7:]))
                if len(out) >= ROWS_OUT:
                    yield _proof_batch(out, carried)
                    out = []
        if out:
            yield _proof_batch(out, carried)

    return sweep


def _proof_batch(rows: list[tuple], carried: Sequence[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    tree, idx, digest, top, ways, *rest = zip(*rows, strict=True)
    left, right, ends = [], [], [0]
    for way in ways:
        while way is not None:
            before, after, way = way
            left.append(before)
            right.append(after)
        ends.append(len(left))
    steps = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], fields=list(_ARROW_PROOF))
    columns = {
        "tree": pa.array(tree, pa.string()),
        "idx": pa.array(idx, pa.int64()),
        "digest": pa.array(digest, pa.string()),
        "top": pa.array(top, pa.string()),
        "proof": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps),
    }
    columns |= {name: pa.array(values, kind) for (name, kind), values in zip(carried, rest, strict=True)}
    return pa.RecordBatch.from_pydict(columns)


def forward(nodes: DataFrame, fan: int = FAN, levels: int = LEVELS) -> list[DataFrame]:
    """The layers above ``nodes`` (tree, idx, size, digest), that table first and the trees' roots last."""
    layers = [nodes]
    while (layers[-1].agg(F.max("size")).first()[0] or 1) > 1:
        blocks = layers[-1].select("tree", _block(fan, levels).alias("block"), "idx", "size", "digest")
        sorted_ = blocks.repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
        layers.append(checkpoint(sorted_.mapInArrow(_up(fan, levels), "tree string, idx long, size long, digest string")))
    return layers


def reverse(layers: Sequence[DataFrame], proofs: DataFrame, carry: Sequence[str] = (), fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """tree, idx, digest, top, proof and the carried columns of the lowest layer's nodes.

    ``proofs`` has tree, top (the tree's root) and the proof that leads from there on.
    """
    told = proofs.select("tree", F.lit(0).cast("long").alias("idx"), "top", "proof")
    if len(layers) == 1:
        layers = [*layers, layers[0].select("tree", "idx", "size", "digest")]
    for number, layer in reversed(list(enumerate(layers[:-1]))):
        named = list(carry) if number == 0 else []
        types = [layer.schema[c].dataType for c in named]
        keys = [F.col("tree"), _block(fan, levels).alias("block")]
        nodes = layer.select(
            *keys, F.lit(1).alias("kind"), "idx", "size", "digest", F.lit(None).cast(PROOF).alias("proof"), *named
        )
        messages = told.select(
            "tree", F.col("idx").alias("block"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("idx"),
            F.lit(None).cast("long").alias("size"), F.col("top").alias("digest"), "proof",
            *[F.lit(None).cast(t).alias(c) for c, t in zip(named, types, strict=True)],
        )
        sorted_ = (
            nodes.unionByName(messages)
            .repartition("tree", "block")
            .sortWithinPartitions("tree", "block", "kind", "idx")
        )
        schema = T.StructType.fromDDL(f"tree string, idx long, digest string, top string, proof {PROOF}")
        for c, t in zip(named, types, strict=True):
            schema.add(c, t)
        arrow = list(zip(named, _arrow_types(types), strict=True))
        told = sorted_.mapInArrow(_down(fan, levels, arrow), schema)
        if number:
            told = checkpoint(told)
    return told


def _arrow_types(types: Sequence[T.DataType]) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    return [to_arrow_type(t) for t in types]


def _block(fan: int, levels: int) -> Column:
    return F.floor(F.col("idx") / F.lit(fan**levels)).cast("long")


def row_proofs(
    rows: DataFrame,
    id_col: str = "doc_id",
    tree_col: str = "source",
    fields: Sequence[str] = FIELDS,
    carry: Mapping[str, Column] | None = None,
    fan: int = FAN,
    levels: int = LEVELS,
) -> DataFrame:
    """doc_id, source, leaf, subroot, root and proof of every row, and the expressions named in ``carry``.

    Rows are read once; digests and ids go on. The root is the one value that
    passes through the driver.
    """
    carry = dict(carry or {})
    carried = [f"carry_{i}" for i in range(len(carry))]
    leaves = checkpoint(
        rows.select(
            rows[f"`{id_col}`"].alias("id"),
            rows[f"`{tree_col}`"].cast("string").alias("tree"),
            leaf_digest([rows[f"`{f}`"] for f in fields]).alias("digest"),
            *[c.alias(name) for name, c in zip(carried, carry.values(), strict=True)],
        )
    )
    placed = with_position(leaves, ["tree", "id", "digest"], "place")
    trees = checkpoint(
        placed.groupBy("tree").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size")).withColumnRenamed("tree", "of")
    )
    nodes = checkpoint(
        placed.join(trees, placed["tree"].eqNullSafe(trees["of"])).select(
            "tree", (F.col("place") - F.col("first")).alias("idx"), "size", "digest", "id", *carried
        )
    )
    layers = forward(nodes, fan, levels)
    roots = layers[-1].select("tree", F.col("digest").alias("subroot"))
    ordered = checkpoint(with_position(roots, ["tree"], "place"))
    upper = ordered.select(
        F.lit(None).cast("string").alias("tree"), (F.col("place") - 1).alias("idx"),
        F.lit(ordered.count()).cast("long").alias("size"), F.col("subroot").alias("digest"), F.col("tree").alias("source"),
    )
    above = forward(upper.select("tree", "idx", "size", "digest"), fan, levels)
    top = above[-1].select("digest").first()
    root = F.lit(top["digest"] if top else None).cast("string")
    whole = above[-1].select("tree", F.col("digest").alias("top"), F.array().cast(PROOF).alias("proof"))
    subproofs = reverse([upper, *above[1:]], whole, ["source"], fan, levels)
    start = checkpoint(subproofs.select(F.col("source").alias("tree"), F.col("digest").alias("top"), "proof"))
    found = reverse(layers, start, ["id", *carried], fan, levels)
    return found.select(
        F.col("id").alias("doc_id"), F.col("tree").alias("source"), F.col("digest").alias("leaf"),
        F.col("top").alias("subroot"), root.alias("root"), "proof",
        *[F.col(c).alias(name) for c, name in zip(carried, carry, strict=True)],
    )
