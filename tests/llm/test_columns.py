"""Filters keep every column, whatever its name, and every row they should."""

from material import prose
from pyspark.sql import functions as F

from docledger.llm import decontaminate, jaccard, langid, mixing

NAMES = [
    "found_key__", "FOUND_KEY___", "gone_id__", "gone_id___", "mix_source__", "mix_rate__", "mix_copy__", "a.b", "it`s", "label", "row_id",
    "component_id", "doc_key", "target", "source_size", "n", "node",
]


def table(spark, rows=60):
    schema = "doc_id long, text string, lang string, source string, " + ", ".join("`" + n.replace("`", "``") + "` string" for n in NAMES)
    texts = [prose(i % 50, 30) for i in range(rows)]
    rows = [(i, t, "en", f"s{i % 3}", *[f"{n} {i}" for n in NAMES]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema).repartition(3)


def intact(found, docs):
    assert found.columns == docs.columns
    rows = found.collect()
    for r in rows:
        assert [r[i + 4] for i in range(len(NAMES))] == [f"{n} {r[0]}" for n in NAMES]
    return [r[0] for r in rows]


def test_mix(spark):
    docs = table(spark)
    ids = intact(mixing.mix(docs), docs)
    expected = {r.doc_id: r.copies for r in mixing.document_copies(docs).collect()}
    assert {i: ids.count(i) for i in expected} == expected


def test_without_contaminated(spark):
    docs = table(spark)
    items = spark.createDataFrame([(1, prose(7, 30)), (2, prose(8, 12))], "item_id long, text string")
    assert sorted(intact(decontaminate.without_contaminated(docs, items), docs)) == [i for i in range(60) if i % 50 not in (7, 8)]


def test_one_of_each(spark):
    docs = table(spark)
    assert sorted(intact(jaccard.one_of_each(docs), docs)) == list(range(50))


def test_accepted(spark):
    docs = table(spark).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("de"))
    model = langid.fit(docs, F.lit(True))
    told = {r.doc_id for r in langid.predict(docs, model).where("accepted").collect()}
    assert set(intact(langid.accepted(docs, model), docs)) == told
