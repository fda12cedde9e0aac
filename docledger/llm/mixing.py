"""Mix sources to target weights by repeating documents.

Tokens are summed per source, a source's target over its size is its repetition
rate, and each document is emitted floor(rate) times plus one more time with a
probability equal to the fraction. The draw is a hash of the seed and the
document's id, so a rerun or a recomputed partition takes the same copies.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; a source without words has target 0 and its documents are not
taken; rows with a null id draw by their text; repeated rows draw alike; an
empty table gives no rows. Columns are addressed by name and kept as they are,
working columns get names that the table does not use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docledger.llm.words import count_words, own_columns, unused
from docledger.session import checkpoint

DEFAULT_WEIGHTS = (5, 2, 1)
DEFAULT_CAP = 3
DEFAULT_SEED = "mix-1"
BROADCAST_SOURCES = 50_000


def uniform(seed: str, doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) that depends on the seed and the document alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.md5(text), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights=DEFAULT_WEIGHTS, cap: int = DEFAULT_CAP) -> DataFrame:
    """One row per source: source, source_size, target.

    Sources in code point order, null last, weigh ``weights`` in turn and share
    the words of all of them; no target passes ``cap`` times its source's size,
    and what is cut goes to the others by weight. In the order of cap over
    weight the capped sources come first, so one running sum finds the level at
    which the rest is filled. Only this table of sources is sorted in one task.
    """
    everything = W.orderBy(F.asc_nulls_last("source"))
    level = W.orderBy(F.expr("ceiling / weight"), "place").rowsBetween(W.unboundedPreceding, -1)
    rest = W.orderBy(F.expr("ceiling / weight"), "place").rowsBetween(W.currentRow, W.unboundedFollowing)
    turn = F.pmod(F.col("place") - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (turn + 1).cast("int")).cast("long")
    filled = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(everything))
        .withColumn("weight", weight)
        .withColumn("ceiling", F.col("source_size") * F.lit(int(cap)))
        .withColumn("before", F.coalesce(F.sum("ceiling").over(level), F.lit(0).cast("long")))
        .withColumn("heavy", F.sum("weight").over(rest))
        .withColumn("whole", F.sum("source_size").over(W.partitionBy()))
        .withColumn("level", (F.col("whole") - F.col("before")) / F.col("heavy"))
        .withColumn("open", F.col("ceiling") > F.col("weight") * F.col("level"))
        .withColumn("open_level", F.min(F.when(F.col("open"), F.struct("before", "level"))).over(W.partitionBy()))
    )
    shared = F.col("weight") * F.col("open_level.level")
    target = F.when(F.col("ceiling") > shared, shared).otherwise(F.col("ceiling").cast("double"))
    return filled.select("source", "source_size", target.alias("target"))


def document_copies(
    docs: DataFrame, weights=DEFAULT_WEIGHTS, cap: int = DEFAULT_CAP, seed: str = DEFAULT_SEED
) -> DataFrame:
    """doc_id, source, size, source_size, target and copies of every document.

    The text is read once; ids, sources and sizes go to the shared folder, and
    the sums per source are made before their shuffle.
    """
    sizes = checkpoint(
        docs.select(
            "doc_id",
            "source",
            count_words(F.col("text")).alias("size"),
            uniform(seed, F.col("doc_id"), F.col("text")).alias("draw"),
        )
    )
    targets = checkpoint(source_targets(sizes, weights, cap))
    known = targets.withColumnRenamed("source", "of_source")
    if targets.count() <= BROADCAST_SOURCES:
        known = F.broadcast(known)
    return sizes.join(known, sizes["source"].eqNullSafe(known["of_source"]), "left").select(
        "doc_id", "source", "size", "source_size", "target", copies(F.col("draw")).alias("copies")
    )


def copies(draw: Column) -> Column:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = F.when(draw < rate - F.floor(rate), 1).otherwise(0)
    return (F.floor(rate) + extra).cast("long")


def mix(docs: DataFrame, weights=DEFAULT_WEIGHTS, cap: int = DEFAULT_CAP, seed: str = DEFAULT_SEED) -> DataFrame:
    """The documents, each as often as the mix takes it, with the columns they came with.

    The rates of the sources join the table directly, so no text is shuffled.
    """
    sizes = docs.select("source", count_words(F.col("text")).alias("size"))
    targets = checkpoint(source_targets(sizes, weights, cap))
    of, rated, copy = (unused(docs, name) for name in ("mix_source__", "mix_rate__", "mix_copy__"))
    known = targets.select(F.col("source").alias(of), F.struct("source_size", "target").alias(rated))
    if targets.count() <= BROADCAST_SOURCES:
        known = F.broadcast(known)
    joined = docs.join(known, docs["source"].eqNullSafe(known[of]), "left")
    size, target = known[rated]["source_size"], known[rated]["target"]
    rate = F.when(size > 0, target / size).otherwise(F.lit(0.0))
    draw = uniform(seed, docs["doc_id"], docs["text"])
    times = (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("int")
    each = F.explode(F.array_repeat(F.lit(0), times)).alias(copy)
    return joined.select(*own_columns(docs), each).drop(copy)
