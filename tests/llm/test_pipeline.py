"""The pipeline's stages, each against a brute-force version on its own input."""

import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from material import prose, words
from test_decontaminate import brute as leaks
from test_jaccard import brute as groups
from test_mixing import targets
from tokenizers import Tokenizer

from docledger.llm import langid, mixing
from docledger.llm.registry import held_out

COLUMNS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    items = [(i, prose(800 + i, 25)) for i in range(6)]
    rows = []
    for i in range(160):
        text = prose(i, 30 + i % 90)
        if i % 16 == 3:
            text += " " + items[i % 6][1]
        if i % 20 == 7:
            text = rows[i - 1][1] if i % 40 == 7 else " ".join([*rows[i - 1][1].split()[:-1], "other"])
        rows.append((i, text, "en" if i % 7 else "xx", f"s{i % 4}" if i % 9 else None, len(text)))
    rows += [(500, None, None, None, 0), (501, "", "en", "s1", 0), (502, "12 34", "en", "s1", 5), (503, "über größe", "de", "s2", 10)]
    path = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(rows, COLUMNS).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["language", "near_duplicates", "decontamination", "mixing", "token_ids"]
    ids = lambda df: Counter(r.doc_id for r in df.collect())
    text = {r.doc_id: r.text for r in docs.collect()}

    spoken = stage["language"](spark, docs, folder).cache()
    model = langid.fit(docs, ~held_out())
    probability = {d: model.probabilities(t) for d, t in text.items()}
    assert ids(spoken) == Counter(d for d, p in probability.items() if p is not None and p.max() >= model.least)
    assert len(ids(spoken)) > 150 and not {500, 501, 502} & set(ids(spoken))

    unique = stage["near_duplicates"](spark, spoken, folder).cache()
    rows = [(d, text[d]) for d in ids(spoken)]
    assert ids(unique) == Counter(d for d, _, c in groups(rows, 5, 80) if d == c)
    assert unique.count() < spoken.count()

    clean = stage["decontamination"](spark, unique, folder).cache()
    held = {d for d, *_ in leaks([(d, text[d]) for d in ids(unique)], items)}
    assert held and ids(clean) == Counter(set(ids(unique)) - held)

    mixed = stage["mixing"](spark, clean, folder).cache()
    taken = {r.doc_id: r.copies for r in mixing.document_copies(clean).collect()}
    assert ids(mixed) == Counter({d: n for d, n in taken.items() if n})
    sizes = Counter()
    for r in clean.collect():
        sizes[r.source] += len(words(r.text))
    expected = targets(dict(sizes))
    assert all(taken[r.doc_id] in (int(expected[r.source] / sizes[r.source]), int(expected[r.source] / sizes[r.source]) + 1) for r in clean.collect())
    for step in (spoken, unique, clean, mixed):
        assert step.columns == docs.columns

    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    written = stage["token_ids"](spark, mixed, folder).collect()
    place = 0
    for r in sorted(written, key=lambda r: r.start):
        found = [*tokenizer.encode(text[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (place, len(found), zlib.crc32(np.array(found, dtype="<u4").tobytes()))
        place += len(found)
    assert Counter(r.doc_id for r in written) == ids(mixed)
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, written))


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
