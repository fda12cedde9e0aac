"""Find benchmark items inside documents: size-partitioned MinHash containment search.

An item is its set of word shingles. Its sketch is its smallest shingle hashes,
a MinHash of containment, so the length of the document doesn't matter. Items
fall into partitions by size; a partition sets how many sketch hashes a document
must share. The sketch is as long as the shingles that a document may lack plus
that number, so by the pigeonhole principle no document with the asked
containment is missed. Candidates are verified by exact containment of shingles
as strings. Only SQL functions run.

Words are lower-cased and split at ASCII white space. An item with fewer words
than a shingle is one shingle of all its words, looked for among the documents'
shingles of that length.

Defined results: a null or empty text, of a document or an item, holds nothing
and is never found; repeated rows are found alike, pairs of ids come once each;
null ids are kept as null; empty tables give no rows; other columns are ignored.
A passage that a third of all documents share costs those documents' hits, which
are combined before their shuffle; nothing is paired within a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docledger.llm.words import unused
from docledger.session import checkpoint

SHINGLE_WORDS = 5
LEAST_PERCENT = 80
BROADCAST_ROWS = 1_000_000  # sketch hashes: 32 bytes each
BROADCAST_CANDIDATES = 200_000  # documents with the keys of the items to look for
BROADCAST_ITEMS = 10_000  # items with their shingles


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")


def _key(row_id: Column, text: Column) -> Column:
    return F.xxhash64(row_id, text)


def _small(df: DataFrame, rows: int, most: int) -> DataFrame:
    """The frame, to be broadcast if its rows were counted and are few; else joins shuffle."""
    return F.broadcast(df) if rows <= most else df.hint("merge")


def _shingle_rows(df: DataFrame, width: int, keep: list[str]) -> DataFrame:
    """A row per shingle of ``width`` words, with its place; column ``words`` holds the words.

    Shingles are made after the explode, as plain expressions of a row, so they
    stay in generated code.
    """
    last = F.size("words") - width
    places = F.when(last >= 0, F.sequence(F.lit(0), last))
    rows = df.select(*keep, "words", F.explode(places).alias("place"))
    return rows.select(*keep, *[F.col("words")[F.col("place") + i].alias(f"w{i}") for i in range(width)])


def _distinct_shingles(width: int) -> Column:
    """The shingles of column ``words`` as strings."""
    last = F.size("words") - width + 1
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.array_distinct(F.transform(places, lambda i: F.array_join(F.slice("words", i, width), " ")))


def item_sketches(items: DataFrame, words: int = SHINGLE_WORDS, percent: int = LEAST_PERCENT):
    """Items (item_key, item_id, width, shingles, n, lacking, needed) and sketch rows (hash, item_key, width, needed)."""
    split = items.select(_key(F.col("item_id"), F.col("text")).alias("item_key"), "item_id", _words(F.col("text")).alias("words"))
    split = split.where(F.size("words") > 0).dropDuplicates(["item_key"])
    width = F.least(F.size("words"), F.lit(words))
    at = F.sequence(F.lit(1), F.size("words") - F.col("width") + 1)
    shingled = split.withColumn("width", width).withColumn(
        "shingles", F.array_distinct(F.transform(at, lambda i: F.array_join(F.slice("words", i, F.col("width")), " ")))
    )
    n = F.size("shingles")
    lacking = F.floor(n * (100 - percent) / 100).cast("int")
    partition = F.floor(F.log2(n.cast("double"))).cast("int")
    needed = F.least(F.greatest(F.lit(1), partition - 2), n - lacking)
    known = checkpoint(
        shingled.withColumn("n", n).withColumn("lacking", lacking).withColumn("needed", needed).drop("words")
    )
    word = F.split("shingle", " ")
    hashes = []
    widths = sorted(r["width"] for r in known.select("width").distinct().collect())
    for w in widths:  # at most ``words`` widths
        each = known.where(F.col("width") == w).select("item_key", "width", "needed", "lacking", F.explode("shingles").alias("shingle"))
        hashes.append(each.select("item_key", "width", "needed", "lacking", F.xxhash64(*[word[i] for i in range(w)]).alias("hash")))
    if not hashes:
        return known, None, widths
    sketch = hashes[0]
    for more in hashes[1:]:
        sketch = sketch.unionByName(more)
    smallest = sketch.groupBy("item_key", "width", "needed", "lacking").agg(F.sort_array(F.collect_set("hash")).alias("all"))
    cut = smallest.select("item_key", "width", "needed", F.explode(F.slice("all", F.lit(1), F.col("lacking") + F.col("needed"))).alias("hash"))
    return known, checkpoint(cut), widths


def contaminated(
    docs: DataFrame, items: DataFrame, words: int = SHINGLE_WORDS, percent: int = LEAST_PERCENT
) -> DataFrame:
    """doc_id, item_id, shared, n_shingles and doc_key of each document that holds at least
    ``percent`` of the item's shingles. ``doc_key`` is a hash of id and text."""
    known, sketch, widths = item_sketches(items, words, percent)
    spark = docs.sparkSession
    if sketch is None:
        return spark.createDataFrame([], "doc_id long, item_id long, shared int, n_shingles int, doc_key long")
    keyed = docs.select("doc_id", "text", _key(F.col("doc_id"), F.col("text")).alias("doc_key"))
    probe = keyed.select("doc_key", _words(F.col("text")).alias("words"))
    sketch_rows = sketch.count()
    hits = None
    for width in widths:
        shingles = _shingle_rows(probe, width, ["doc_key"])
        hashed = shingles.select("doc_key", F.xxhash64(*[F.col(f"w{i}") for i in range(width)]).alias("hash"))
        own = _small(sketch.where(F.col("width") == width).drop("width"), sketch_rows, BROADCAST_ROWS)
        hit = hashed.join(own, "hash").select("doc_key", "item_key", "needed", "hash")
        hits = hit if hits is None else hits.unionByName(hit)
    candidates = checkpoint(
        hits.distinct().groupBy("doc_key", "item_key", "needed").agg(F.count("*").alias("hits"))
        .where(F.col("hits") >= F.col("needed")).groupBy("doc_key").agg(F.collect_set("item_key").alias("asked"))
    )
    # What is asked of a document is a list of item keys; the items' shingles join after the texts are picked.
    split = keyed.join(_small(candidates, candidates.count(), BROADCAST_CANDIDATES), "doc_key").select(
        "doc_key", "doc_id", _words(F.col("text")).alias("words"), "asked"
    )
    shingled = split.select("doc_key", "doc_id", "asked", *[_distinct_shingles(w).alias(f"has_{w}") for w in widths])
    each = shingled.select("doc_key", "doc_id", F.explode("asked").alias("item_key"), *[f"has_{w}" for w in widths])
    item = known.select("item_key", F.struct("item_id", "width", "shingles", "n", "lacking").alias("a"))
    each = each.join(_small(item, known.count(), BROADCAST_ITEMS), "item_key")
    shared = F.lit(0)
    for w in widths:
        shared = F.when(F.col("a.width") == w, F.size(F.array_intersect(F.col("a.shingles"), F.col(f"has_{w}")))).otherwise(shared)
    verified = each.select(
        "doc_id", F.col("a.item_id").alias("item_id"), shared.alias("shared"), F.col("a.n").alias("n_shingles"),
        F.col("a.lacking").alias("lacking"), "doc_key",
    )
    return verified.where(F.col("shared") >= F.col("n_shingles") - F.col("lacking")).drop("lacking")


def without_contaminated(docs: DataFrame, items: DataFrame, words: int = SHINGLE_WORDS, percent: int = LEAST_PERCENT) -> DataFrame:
    """The documents that hold no item, with the columns they came with."""
    found = checkpoint(contaminated(docs, items, words, percent).select("doc_key").distinct())
    key = unused(docs, "found_key__")
    return docs.join(
        _small(found.withColumnRenamed("doc_key", key), found.count(), BROADCAST_CANDIDATES),
        _key(docs["doc_id"], docs["text"]) == F.col(key), "left_anti",
    )
