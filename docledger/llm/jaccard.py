"""N-gram Jaccard join: candidates share prefixes under several token orders.

A document is its set of distinct word shingles. If two sets are as similar as
asked, then under any order of all shingles they share one among the first few
of each, the prefix. Each order here sorts by frequency class, rare ones first,
then by a hash of its own, so common shingles are in hardly any prefix and the
orders err independently. A pair must share a prefix shingle under every order
before its sets are compared exactly, so the filters are intersected first.

1. One pass counts shingles in a sketch of fixed size (counters, not rows) and
   gives every document its set size and a digest of its set. Equal sets are one
   node from here on, so groups of exact copies cost nothing.
2. A second pass emits the prefixes, each shingle with its place in the order.
   Rows of one shingle meet, sorted by set size; lone ones, most of them, go no
   further. Two sets can only be similar enough if, after the places of the
   first shingle they share, both have enough left, and if their sizes fit.
3. Within a shingle each node is paired with a few of its neighbours, not with
   all. Neighbours under every order are connected, and what is connected is a
   family: one common shingle makes none, however many sets have it. A family's
   sets, each once, come to one task, which finds all its links; what it hands over is a forest. A
   family beyond ``FAMILY_NODES`` or ``FAMILY_SHINGLES`` is not gathered: its
   neighbours are compared pair by pair, and all its other pairs below.
4. Every pair of nodes of different families that share a shingle and fit is a
   candidate under that order. Pairs that are candidates under all orders are
   compared, so no link is lost. Components of all links are the result.

Pairs are compared by counts first: a set's shingles fall into buckets by their
lowest bits, and two sets share no more than the smaller count of each bucket.
Sets move only for pairs whose counts allow a link.

Set comparison is exact on 64-bit hashes of the shingles. Nodes are 64-bit
digests; a second digest checks them, and two sets with one digest raise.

The sketch has ``1 << SKETCH_BITS`` counters at any size of the input. Once most
counters are used up, classes tell less, candidates grow and results stay
exact; the bits are a parameter for that.

Defined results: null and empty texts have no shingles and no link, their
component is their own id; a text with fewer words than a shingle is one shingle
of all its words; repeated rows are each returned; a null id is never a
component's name unless the component has no other; an empty table gives no
rows; other columns are ignored, or kept where rows are filtered.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.llm.components import components
from docledger.llm.words import mixed, unused, utf8_rows, window_hashes, with_room, word_hashes, written
from docledger.session import checkpoint

ORDERS = 2
SKETCH_BITS = 22
SLICES = 16
MERGED_AT_ONCE = 64
BROADCAST_NODES = 1_000_000
FAMILY_NODES = 4_000
FAMILY_SHINGLES = 2_000_000
DOCUMENTS_AT_ONCE = 500
NEIGHBOURS = (1, 2, 4)
LEAST_BUCKETS, MOST_BUCKETS = 64, 4_096

_KEYS = [np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB), np.uint64(0x8EBC6AF09C88C6E3), np.uint64(0x589965CC75374CC3)]
_DIGEST, _CHECK = np.uint64(0x1D8E4E27C47D124F), np.uint64(0xEB44ACCAB455D165)


def shingle_set(data: np.ndarray, width: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text, given as UTF-8 bytes."""
    words = word_hashes(data, lower=True)[2]
    return np.unique(window_hashes(words, min(width, len(words)))) if len(words) else words


def digests(shingles: np.ndarray) -> tuple[int, int]:
    size = np.uint64(len(shingles))
    return tuple(
        int(mixed(np.array([mixed(shingles ^ key).sum(dtype=np.uint64) + size]))[0].view(np.int64)) for key in (_DIGEST, _CHECK)
    )


def _measured(width: int, bits: int):
    """Per document its set's size and digests, and per task the counters in slices."""

    @with_room
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << bits, dtype=np.uint32)
        shift = np.uint64(64 - bits)
        for batch in batches:
            sizes, nodes, checks = [], [], []
            for data in utf8_rows(batch.column("text")):
                shingles = shingle_set(data, width)
                np.add.at(counters, (shingles >> shift).astype(np.int64), 1)
                node, check = digests(shingles) if len(shingles) else (None, None)
                sizes.append(len(shingles))
                nodes.append(node)
                checks.append(check)
            n = len(sizes)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"), "row_id": batch.column("row_id"), "n": pa.array(sizes, pa.int64()),
                    "node": pa.array(nodes, pa.int64()), "check": pa.array(checks, pa.int64()),
                    "slice": pa.nulls(n, pa.int32()), "task": pa.nulls(n, pa.int64()), "counts": pa.nulls(n, pa.binary()),
                }
            )
        if counters.any():
            task = TaskContext.get().partitionId()
            yield _slices(np.split(counters, SLICES), range(SLICES), [task] * SLICES, batch.schema.field("doc_id").type)

    return measure


def _slices(parts, numbers, tasks, id_type) -> pa.RecordBatch:
    n = len(parts)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.nulls(n, id_type), "row_id": pa.nulls(n, pa.int64()), "n": pa.nulls(n, pa.int64()), "node": pa.nulls(n, pa.int64()), "check": pa.nulls(n, pa.int64()),
            "slice": pa.array(list(numbers), pa.int32()), "task": pa.array(tasks, pa.int64()),
            "counts": pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary()),
        }
    )


def _added(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zlib.decompress(c.as_py()), dtype=np.uint32).astype(np.uint64) for c in table["counts"])
    total = np.minimum(total, np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return pa.table({"slice": table["slice"][:1], "task": table["task"][:1], "counts": [zlib.compress(total.tobytes(), 1)]},
                    schema=pa.schema([("slice", pa.int32()), ("task", pa.int64()), ("counts", pa.binary())]))


def frequency_classes(sketches: DataFrame, bits: int) -> np.ndarray:
    """Class of each counter, about two to a doubling: one byte each, whatever the input's size.

    Sketches of the tasks are added slice by slice, a bounded number at a time.
    """
    most = sketches.agg(F.max("task")).first()[0]
    classes = np.zeros(1 << bits, dtype=np.uint8)
    if most is None:
        return classes
    while most:
        sketches = (
            sketches.withColumn("task", F.floor(F.col("task") / MERGED_AT_ONCE).cast("long"))
            .groupBy("slice", "task").applyInArrow(_added, "slice int, task long, counts binary")
        )
        most //= MERGED_AT_ONCE
    for row in sketches.toLocalIterator():
        counts = np.frombuffer(zlib.decompress(bytes(row["counts"])), dtype=np.uint32)
        size = len(counts)
        classes[row["slice"] * size : (row["slice"] + 1) * size] = np.floor(2 * np.log2(1.0 + counts))
    return classes


def prefix_length(n, percent: int):
    """Shingles of a set of ``n`` of which a set similar enough must share one."""
    return n - (percent * n + 99) // 100 + 1


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few documents, as what is made of a document is larger than the document."""
    for batch in batches:
        for start in range(0, batch.num_rows, DOCUMENTS_AT_ONCE):
            yield batch.slice(start, DOCUMENTS_AT_ONCE)


def _prefixes(width: int, percent: int, orders: int, shared_classes, bits: int):
    @with_room
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared_classes.value
        shift = np.uint64(64 - bits)
        seen: set[int] = set()
        for batch in _parts(batches):
            which, keys, nodes, sizes, places = [], [], [], [], []
            for data in utf8_rows(batch.column("text")):
                shingles = shingle_set(data, width)
                n = len(shingles)
                if not n:
                    continue
                node = digests(shingles)[0]
                if node in seen:
                    continue
                seen.add(node)
                rank = classes[(shingles >> shift).astype(np.int64)].astype(np.uint64) << np.uint64(55)
                length = prefix_length(n, percent)
                for k in range(orders):
                    key = rank | (mixed(shingles ^ _KEYS[k]) >> np.uint64(9))
                    key = np.sort(np.partition(key, length - 1)[:length] if length < n else key)
                    places.append(np.arange(length, dtype=np.int32))
                    which.append(np.full(length, k, dtype=np.int8))
                    keys.append(key.view(np.int64))
                    nodes.append(np.full(length, node, dtype=np.int64))
                    sizes.append(np.full(length, n, dtype=np.int32))
            if keys:
                yield pa.RecordBatch.from_pydict(
                    {"k": np.concatenate(which), "key": np.concatenate(keys), "node": np.concatenate(nodes), "n": np.concatenate(sizes), "place": np.concatenate(places)}
                )

    return emit


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Batches of sorted rows as arrays that end where a (k, key) ends."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in columns}
        if held is not None:
            rows = {c: np.concatenate((held[c], rows[c])) for c in columns}
        edge = np.flatnonzero((rows["key"][1:] != rows["key"][:-1]) | (rows["k"][1:] != rows["k"][:-1]))
        if not len(edge):
            held = rows
            continue
        cut = edge[-1] + 1
        held = {c: v[cut:] for c, v in rows.items()}
        yield {c: v[:cut] for c, v in rows.items()}
    if held is not None and len(held["key"]):
        yield held


def _same(rows: dict[str, np.ndarray]) -> np.ndarray:
    return (rows["key"][1:] == rows["key"][:-1]) & (rows["k"][1:] == rows["k"][:-1])


def _fitting(rows: dict[str, np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Of pairs of rows of one shingle, left not larger: whether sizes and places allow a link."""
    a, b = rows["n"][left].astype(np.int64), rows["n"][right].astype(np.int64)
    needed = (percent * (a + b) + 99 + percent) // (100 + percent)
    return np.minimum(a - rows["place"][left], b - rows["place"][right]) >= needed


def _met(percent: int):
    """Rows of shingles that two nodes or more have, with the neighbours that fit."""

    @with_room
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ["k", "key", "node", "n", "place"]):
            again = np.concatenate(([False], _same(rows) & (rows["node"][1:] == rows["node"][:-1])))
            rows = {c: v[~again] for c, v in rows.items()}
            same = _same(rows)
            many = np.concatenate((same, [False])) | np.concatenate(([False], same))
            rows = {c: v[many] for c, v in rows.items()}
            total = len(rows["key"])
            if not total:
                continue
            group = np.concatenate(([0], np.cumsum(~_same(rows))))
            out = {c: pa.array(v) for c, v in rows.items()}
            for step in NEIGHBOURS:
                right = np.arange(min(step, total), total)
                fits = (group[right - step] == group[right]) & _fitting(rows, right - step, right, percent)
                other = np.zeros(total, dtype=np.int64)
                none = np.ones(total, dtype=bool)
                other[right[fits]] = rows["node"][right[fits] - step]
                none[right[fits]] = False
                out[f"next_{step}"] = pa.array(other, mask=none)
            yield pa.RecordBatch.from_pydict(out)

    return meet


def _crossing(percent: int, most: int = 1 << 18):
    """All pairs of nodes of one shingle that fit and are in different families."""

    @with_room
    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, ["k", "key", "node", "n", "place", "part"]):
            total = len(rows["key"])
            group = np.concatenate(([0], np.cumsum(~_same(rows))))
            left = np.arange(total)
            step = 0
            part, node = rows["part"], rows["node"]
            while len(left):
                step += 1
                left = left[left + step < total]
                right = left + step
                near = (group[left] == group[right]) & (rows["n"][left].astype(np.int64) * 100 >= rows["n"][right].astype(np.int64) * percent)
                left, right = left[near], right[near]
                apart = part[left] != part[right]
                x, y = left[apart], right[apart]
                fits = _fitting(rows, x, y, percent)
                x, y = x[fits], y[fits]
                a, b, k = node[x], node[y], rows["k"][x]
                for start in range(0, len(a), most):
                    some = slice(start, start + most)
                    yield pa.RecordBatch.from_pydict({"a": np.minimum(a[some], b[some]), "b": np.maximum(a[some], b[some]), "k": k[some]})

    return cross


def _resolved(percent: int):
    """All links of a family, as a forest: each set is compared with all others at once."""

    def resolve(table: pa.Table) -> pa.Table:
        nodes = table["node"].to_numpy()
        sets = table["shingles"].combine_chunks()
        sets = sets.chunk(0) if isinstance(sets, pa.ChunkedArray) else sets
        offsets = np.asarray(sets.offsets)
        ids = np.unique(sets.values.to_numpy()[offsets[0] : offsets[-1]], return_inverse=True)[1]
        starts = offsets[:-1] - offsets[0]
        sizes = np.diff(offsets)
        label = np.arange(len(nodes))
        mark = np.zeros(int(ids.max()) + 1, dtype=np.int32)
        a, b = [], []
        for i in range(len(nodes)):
            if (label == label[i]).all():
                break
            own = ids[starts[i] : starts[i] + sizes[i]]
            mark[own] = 1
            shared = np.add.reduceat(mark[ids], starts)
            mark[own] = 0
            linked = shared * 100 >= (sizes + sizes[i] - shared) * percent
            for other in np.unique(label[linked]):
                if other != label[i]:
                    at = int(np.flatnonzero(linked & (label == other))[0])
                    a.append(nodes[i])
                    b.append(nodes[at])
                    label[label == other] = label[i]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return resolve


def bucket_counts(shingles: np.ndarray) -> bytes:
    """Shingles in each bucket, a byte each, one or two to a bucket; none where a byte can't hold them."""
    buckets = min(max(LEAST_BUCKETS, 1 << (len(shingles) // 2).bit_length()), MOST_BUCKETS)
    counts = np.bincount((shingles & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return counts.astype(np.uint8).tobytes() if counts.max() <= 255 else b""


def shared_at_most(a: bytes, b: bytes) -> int:
    """No two sets with these counts share more shingles; buckets of the longer ones are added up."""
    x, y = sorted((np.frombuffer(a, np.uint8).astype(np.int64), np.frombuffer(b, np.uint8).astype(np.int64)), key=len)
    return int(np.minimum(x, y.reshape(-1, len(x)).sum(axis=0)).sum())


def _allowed(percent: int):
    """The pairs whose counts allow a link, and those without counts."""

    @with_room
    def allow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), batch.column("all").to_pylist(), strict=True)
            keep = [not x or not y or shared_at_most(x, y) * (100 + percent) >= n * percent for x, y, n in rows]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return allow


def _sets(width: int):
    @with_room
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            sets = [shingle_set(data, width) for data in utf8_rows(batch.column("text"))]
            yield pa.RecordBatch.from_pydict(
                {
                    **{c: batch.column(c) for c in batch.schema.names if c != "text"},
                    "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    "counts": pa.array([bucket_counts(s) for s in sets], pa.binary()),
                }
            )

    return make


def _shingles_of(asked: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """node, family, shingles and counts of the nodes ``asked`` for (node, row_id, family), a row for each row of texts.

    Their texts are read again. The ids are broadcast if they were counted and
    are few, else texts are shuffled.
    """
    wanted = asked.select(F.col("row_id").alias("wanted_id"), "node", "family")
    if asked.count() <= BROADCAST_NODES:
        wanted = F.broadcast(wanted)
    narrow = docs.select("doc_id", "text")
    texts = narrow.join(wanted, F.xxhash64("doc_id", "text") == F.col("wanted_id")).select("node", "family", "text")
    return texts.mapInArrow(_sets(width), "node long, family long, shingles array<long>, counts binary")


def _linked(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, compared exactly, pair by pair.

    Counts of buckets, an eighth of a set or less, are compared first; sets are
    joined to the pairs that remain.
    """
    asked = checkpoint(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes, "node"))
    sets = written(_shingles_of(asked.withColumn("family", F.col("node")), docs, width).dropDuplicates(["node"]), "jaccard-sets")
    size = F.size("shingles")
    left = sets.select(F.col("node").alias("a"), F.col("counts").alias("left"), size.alias("left_n"))
    right = sets.select(F.col("node").alias("b"), F.col("counts").alias("right"), size.alias("right_n"))
    counted = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right", (F.col("left_n") + F.col("right_n")).alias("all"))
    pairs = checkpoint(counted.mapInArrow(_allowed(percent), "a long, b long"))
    ends = checkpoint(pairs.select(F.explode(F.array("a", "b")).alias("end")).distinct())
    ends = F.broadcast(ends) if ends.count() <= BROADCAST_NODES else ends
    sets = sets.join(ends, F.col("node") == F.col("end"), "left_semi")
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    shared = F.size(F.array_intersect("left", "right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", shared.alias("shared"), (F.size("left") + F.size("right")).alias("all"))
    return checkpoint(both.where(F.col("shared") * 100 >= (F.col("all") - F.col("shared")) * percent).select("a", "b"))


def jaccard_components(
    docs: DataFrame, width: int = 4, percent: int = 85, orders: int = ORDERS, bits: int = SKETCH_BITS
) -> DataFrame:
    """doc_id, n_shingles, component_id and row_id (a hash of id and text) of every row.

    Two documents link when 100 * shared >= percent * union.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, row_id long, n long, node long, check long, slice int, task long, counts binary"
    texts = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_id"), "text")
    measured = written(texts.mapInArrow(_measured(width, bits), schema), "jaccard-sizes")
    rows = measured.where(F.col("slice").isNull()).select("doc_id", "row_id", "n", "node", "check")
    known = rows.where(F.col("node").isNotNull())
    if known.groupBy("node").agg((F.min("check") != F.max("check")).alias("clash")).where("clash").limit(1).count():
        raise ValueError("two shingle sets have one digest; change the digest's constants")
    nodes = checkpoint(known.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.min("row_id").alias("row_id"), F.first("n").alias("n")))
    sketches = measured.where(F.col("slice").isNotNull()).select("slice", "task", "counts")
    classes = spark.sparkContext.broadcast(frequency_classes(sketches, bits))  # fixed size
    index = docs.select("text").mapInArrow(
        _prefixes(width, percent, orders, classes, bits), "k tinyint, key long, node long, n int, place int"
    )
    sort = ["k", "key", "n", "node"]
    columns = "k tinyint, key long, node long, n int, place int"
    nexts = [f"next_{step}" for step in NEIGHBOURS]
    met = written(
        index.repartition("k", "key").sortWithinPartitions(*sort).mapInArrow(
            _met(percent), ", ".join([columns, *[f"{c} long" for c in nexts]])
        ),
        "jaccard-index",
    )
    every = F.expr("bit_or(shiftleft(1, cast(k as int)))")
    under_every = F.col("under") == (1 << orders) - 1
    beside = met.select("k", "node", F.explode(F.array_compact(F.array(*nexts))).alias("other"))
    beside = beside.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), "k")
    near = checkpoint(beside.groupBy("a", "b").agg(every.alias("under")).where(under_every).select("a", "b"))
    family = components(near).withColumnRenamed("label", "family")
    sized = family.join(nodes, "node")
    sizes = sized.groupBy("family").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    small = (F.col("members") <= FAMILY_NODES) & (F.col("shingles") <= FAMILY_SHINGLES)
    placed = checkpoint(sized.join(sizes.select("family", small.alias("small")), "family").select("node", "row_id", "family", "small"))
    gathered = placed.where("small")
    found = _shingles_of(gathered, docs, width).drop("counts").repartition("family").dropDuplicates(["family", "node"])
    inside = checkpoint(found.groupBy("family").applyInArrow(_resolved(percent), "a long, b long"))
    large = placed.where(~F.col("small")).select(F.col("node").alias("a"))
    apart = checkpoint(near.join(large, "a"))
    linked = inside.unionByName(_linked(apart, docs, nodes, width, percent)) if apart.limit(1).count() else inside
    within = placed.where("small").select(F.col("node").alias("member"), F.col("family").alias("label"))
    if apart.limit(1).count():
        joined = components(linked).join(large.withColumnRenamed("a", "node"), "node").select(F.col("node").alias("member"), "label")
        within = within.unionByName(joined)
    parted = met.select("k", "key", "node", "n", "place").join(within, F.col("node") == F.col("member"), "left").select(
        "k", "key", "node", "n", "place", F.coalesce("label", "node").alias("part")
    )
    crossing = parted.repartition("k", "key").sortWithinPartitions(*sort).mapInArrow(
        _crossing(percent), "a long, b long, k tinyint"
    )
    candidates = checkpoint(crossing.groupBy("a", "b").agg(every.alias("under")).where(under_every).select("a", "b"))
    links = linked.unionByName(_linked(candidates, docs, nodes, width, percent)) if candidates.limit(1).count() else linked
    joined = components(links)
    named = nodes.join(joined, "node", "left").select("node", "first_id", F.coalesce("label", "node").alias("label"))
    names = named.groupBy("label").agg(F.min("first_id").alias("component_id"))
    members = named.join(names, "label").select(F.col("node").alias("member"), "component_id")
    return rows.join(members, F.col("node") == F.col("member"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), "row_id"
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near copies: of each component the row with the smallest id.

    Documents without words are in no component and stay. Columns are kept.
    """
    found = checkpoint(jaccard_components(docs, width, percent))
    worded = found.where(F.col("n_shingles") > 0)
    best = worded.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_id")).alias("best"))
    gone = worded.select("row_id").distinct().join(best.select(F.col("best.row_id").alias("row_id")), "row_id", "left_anti")
    name = unused(docs, "gone_id__")
    gone = checkpoint(gone.withColumnRenamed("row_id", name))
    few = gone.count() <= BROADCAST_NODES
    left = docs.join(F.broadcast(gone) if few else gone, F.xxhash64(docs["doc_id"], docs["text"]) == F.col(name), "left_anti")
    if worded.groupBy("row_id").count().where("count > 1").limit(1).count():
        left = left.dropDuplicates(["doc_id", "text"])
    return left
