import numpy as np
from material import awkward, documents
from pyspark.sql import functions as F

from docledger.llm import langid, registry

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_calibration(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = registry.op4_langid(spark, FOLDER).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    right = np.array([r.lang_pred == r.lang for r in rows])
    score = np.array([r.score for r in rows])
    assert len(rows) > 150 and right.mean() > 0.95
    assert abs(score.mean() - right.mean()) < 0.05
    assert np.mean([r.accepted for r in rows]) > 0.97


def test_every_row_and_the_odd_ones(spark):
    rows = awkward() + [(50, "1234 !?"), (51, "\ud83d" * 0 + "𝔘𝔫"), (52, "x" * (langid.STRETCH + 10))]
    docs = documents(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").when(F.col("doc_id") % 3 == 0, "de"))
    model = langid.fit(docs, F.lit(True))
    got = langid.predict(docs, model).collect()
    assert len(got) == len(rows)
    texts = sorted((str(i), any(c.isalpha() for c in t or "")) for i, t in rows)
    assert sorted((str(r.doc_id), r.lang_pred != "und") for r in got) == texts
    for r in got:
        assert 0 <= r.score <= 1 and (r.lang_pred in ("de", "en") or (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False))
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.accepted)


def test_no_label_one_label_and_no_rows(spark):
    docs = documents(spark, awkward())
    none = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r.lang_pred for r in langid.predict(docs, none).collect()} == {"und"}
    assert langid.accepted(docs, none).count() == 0
    one = langid.fit(docs.withColumn("lang", F.lit("xx")), F.lit(True))
    assert {r.lang_pred for r in langid.predict(docs, one).collect()} == {"xx", "und"}
    assert langid.predict(docs.limit(0), one).collect() == []


def test_rejection_is_for_mixed_and_foreign_text():
    rng = np.random.default_rng(0)
    word = lambda letters: "".join(rng.choice(list(letters), 5))
    text = lambda letters, n: " ".join(word(letters) for _ in range(n))
    samples = [(lang, *langid.bucket_counts(text(letters, 40))) for _ in range(60) for lang, letters in (("aa", "abcdef"), ("bb", "uvwxyz"))]
    model = langid.train([(a, b, c.astype(float)) for a, b, c in samples])
    assert model.labels == ("aa", "bb") and 0 < model.least <= 0.5
    assert model.probabilities(text("abcdef", 20))[0] > 0.9 and model.probabilities(text("uvwxyz", 20))[1] > 0.9


def test_stretches_count_every_n_gram_once(monkeypatch):
    text = "Straße übers Feld, und zurück. " * 9
    whole = langid.bucket_counts(text)
    monkeypatch.setattr(langid, "STRETCH", 50)
    cut = langid.bucket_counts(text)
    assert abs(int(cut[1].sum()) - int(whole[1].sum())) <= 4 * (len(text) // 50)
    assert set(whole[0]) <= set(cut[0])
