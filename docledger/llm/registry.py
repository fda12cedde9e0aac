"""Queries of the subpackage by name, with their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docledger.llm import (
    chat,
    decontaminate,
    jaccard,
    langid,
    merkle,
    mixing,
    negatives,
    quality,
    recipes,
    secrets,
    substrings,
    tokenids,
    topk,
)
from docledger.llm.words import scratch_folder, ship_package
from docledger.operators.ordering import with_position


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, folder, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"),
        F.sha2(secrets.joined_spans(F.col("base")), 256).alias("base_sha256"),
        secrets.joined_spans(F.col("spans")).alias("spans"),
    )


def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.document_copies(_table(spark, folder, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


OP2_SQL = r"""
with sizes as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
         cast(('0x' || substr(md5('mix-1:' || coalesce(cast(doc_id as varchar), md5(text), '')), 1, 13)) as bigint)
           / 4503599627370496.0::double as draw
  from documents
), sources as (
  select source, cast(sum(size) as bigint) as source_size from sizes group by source
), placed as (
  select *, row_number() over (order by source nulls last) as place from sources
), weighted as (
  select *, case (place - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight, 3 * source_size as ceiling from placed
), filled as (
  select *,
    cast((sum(source_size) over ()) - coalesce(sum(ceiling) over (order by ceiling / weight::double, place
      rows between unbounded preceding and 1 preceding), 0) as double)
    / cast(sum(weight) over (order by ceiling / weight::double, place
      rows between current row and unbounded following) as double) as level,
    row_number() over (order by ceiling / weight::double, place) as turn
  from weighted
), opened as (
  select min_by(level, turn) as level from filled where ceiling > weight * level
), targets as (
  select f.source, f.source_size,
    case when f.ceiling > f.weight * o.level then f.weight * o.level else cast(f.ceiling as double) end as target
  from filled f left join opened o on true
), rated as (
  select s.doc_id, s.size, s.draw, t.source_size, t.target,
    case when t.source_size > 0 then t.target / t.source_size else 0.0::double end as rate
  from sizes s join targets t on s.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  cast((floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end) * size as bigint) as taken
from rated
"""


def _chains(conversations: DataFrame, extra: DataFrame) -> DataFrame:
    """Rows by turn as reply trees in which each row answers the one before it."""
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    placed = with_position(rows, ["conv_id", "turn", "role", "text"], "node_id")
    first = placed.groupBy("conv_id").agg(F.min("node_id").alias("first")).withColumnRenamed("conv_id", "c")
    joined = placed.join(first, placed["conv_id"].eqNullSafe(first["c"]))
    return joined.select(
        "conv_id", "node_id", F.when(F.col("node_id") > F.col("first"), F.col("node_id") - 1).alias("parent_id"),
        "role", F.coalesce("text", F.lit("")).alias("text"), F.length(F.coalesce("text", F.lit(""))).alias("score"),
    )


def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    conversations = _table(spark, folder, "conversations")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn int, role string, text string"
    )
    formatted = chat.formatted(chat.chosen_paths(_chains(conversations, extra)))
    read = formatted.select(
        "conv_id", "formatted",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def held_out() -> Column:
    """The fold that no model learns from: ids whose CRC as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def op4_langid(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = langid.fit(docs, ~held_out())
    return langid.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")


def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "shared", "n_shingles").distinct()


OP5_SQL = r"""
with said as (
  select doc_id, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents
), asked as (
  select item_id, text, list_filter(regexp_split_to_array(lower(text), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from benchmark
), items as (
  select item_id, text, least(len(w), 5) as width, unnest(list_distinct(list_transform(range(1, len(w) - least(len(w), 5) + 2),
    lambda i: array_to_string(w[i:i + least(len(w), 5) - 1], ' ')))) as shingle
  from asked where len(w) > 0
), widths as (
  select distinct width from items
), shingles as (
  select distinct doc_id, w, width, shingle from (
    select doc_id, w, width, unnest(list_transform(range(1, len(w) - width + 2),
      lambda i: array_to_string(w[i:i + width - 1], ' '))) as shingle
    from said, widths where len(w) >= width)
), sizes as (
  select item_id, text, width, count(*) as n_shingles from items group by all
), found as (
  select s.doc_id, s.w, i.item_id, i.text, count(*) as shared
  from shingles s join items i on s.width = i.width and s.shingle = i.shingle group by all
)
select distinct f.doc_id, f.item_id, cast(f.shared as integer) as shared, cast(z.n_shingles as integer) as n_shingles
from found f join sizes z on f.item_id = z.item_id and f.text = z.text
where 100 * f.shared >= 80 * z.n_shingles
"""


def op6_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(_table(spark, folder, "documents"))


def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = quality.fit(docs, _table(spark, folder, "labels"), ~held_out())
    return quality.score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op10_tokenids(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    written = tokenids.write_token_ids(
        _table(spark, folder, "documents"), scratch_folder(spark, "tokenids"), public_tokenizers.path("byte_bpe_50k.json")
    )
    return tokenids.read_token_ids(spark, written)


def op9_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return topk.exact_top_k(vectors, F.col("vec_id") % 20 == 0)


OP9_SQL = """
with codes as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v, row_number() over () as r
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select q.vec_id as query_id, q.r as qr, c.vec_id, c.r,
    cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from codes q join codes c on q.r <> c.r and len(q.v) = len(c.v)
  where q.vec_id % 20 = 0
), ranked as (
  select query_id, vec_id, score, row_number() over (partition by qr order by score desc, vec_id, r) as rank from pairs
)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 20
"""



def manifest(docs: DataFrame, fan: int = merkle.FAN, levels: int = merkle.LEVELS) -> DataFrame:
    """Proofs of all rows, folded from leaves of which some lost their line breaks."""
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    text = F.when(touched, F.translate("text", "\n", "")).otherwise(F.col("text"))
    received = merkle.leaf_digest([text if f == "text" else F.col(f) for f in merkle.FIELDS])
    proofs = merkle.row_proofs(docs, carry={"received": received}, fan=fan, levels=levels)
    found = proofs.select(
        "doc_id", "leaf", "subroot", "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        merkle.folded(F.col("received"), F.col("proof")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return manifest(_table(spark, folder, "documents"))


def op12_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


OP12_SQL = """
with codes as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, row_number() over () as r,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select q.vec_id as anchor_id, q.r as anchor, q.label = c.label as same, c.vec_id, c.r,
    cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from codes q join codes c on q.r <> c.r and len(q.v) = len(c.v)
  where q.vec_id % 100 = 0
), positives as (
  select * from (
    select *, row_number() over (partition by anchor order by score desc, vec_id nulls last, r) as place from pairs where same)
  where place <= 5
), ranked as (
  select p.anchor_id, p.vec_id as positive_id, n.vec_id as negative_id, p.score as positive_score, n.score as negative_score,
    row_number() over (partition by p.anchor, p.place order by n.score desc, n.vec_id nulls last, n.r) as rank
  from positives p join pairs n on p.anchor = n.anchor
  where not n.same and 30 * p.score <= 100 * n.score and 100 * n.score <= 90 * p.score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from ranked where rank <= 10
"""


def op13_recipes(spark: SparkSession, folder: str) -> DataFrame:
    return recipes.equal_texts(_table(spark, folder, "documents"))


OP13_SQL = """
select doc_id, max(doc_id) over same as keep_id, cast(count(*) over same as bigint) as group_size,
  row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 as kept,
  sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_mixing": op2_mixing,
    "op3_chat": op3_chat,
    "op4_langid": op4_langid,
    "op5_decontaminate": op5_decontaminate,
    "op6_jaccard": op6_jaccard,
    "op7_substrings": op7_substrings,
    "op8_quality": op8_quality,
    "op9_topk": op9_topk,
    "op10_tokenids": op10_tokenids,
    "op11_merkle": op11_merkle,
    "op12_negatives": op12_negatives,
    "op13_recipes": op13_recipes,
}

SQL: dict[str, str] = {"op2_mixing": OP2_SQL, "op5_decontaminate": OP5_SQL, "op9_topk": OP9_SQL, "op12_negatives": OP12_SQL, "op13_recipes": OP13_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return build(spark, folder)

        return run

    return {name: shipped(build) for name, build in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
