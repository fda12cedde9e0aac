from collections import defaultdict

import pytest
from material import awkward, documents, words

from docledger.llm import mixing


def targets(sizes: dict, weights=(5, 2, 1), cap=3) -> dict:
    """Share by weight, cut at the cap, share what was cut again, until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = [s for s in open_ if share[s] > cap * sizes[s]]
        if not above:
            return capped | share
        capped |= {s: cap * sizes[s] for s in above}


def test_targets_and_copies(spark):
    texts = awkward() + [(100 + i, "w " * (5 + i % 7)) for i in range(300)]
    docs = documents(spark, texts)
    rows = mixing.document_copies(docs).collect()
    assert len(rows) == len(texts)
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += len(words(r.text))
    expected = targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
        rate = r.target / r.source_size
        assert int(rate) <= r.copies <= min(3, int(rate) + 1)


def test_capped_sources_hand_their_share_on(spark):
    texts = [(i, "w " * (1 if i % 3 == 1 else 100)) for i in range(90)]
    rows = mixing.document_copies(documents(spark, texts)).collect()
    small = [r for r in rows if r.source == "a"]
    assert {r.target for r in small} == {3.0 * small[0].source_size} and {r.copies for r in small} == {3}
    assert sum({r.source: r.target for r in rows}.values()) == pytest.approx(sum({r.source: r.source_size for r in rows}.values()))


def test_mix_emits_the_copies_with_all_columns_and_repeats_itself(spark):
    docs = documents(spark, [(i, f"some words here {i}") for i in range(200)])
    taken = mixing.mix(docs)
    assert taken.columns == docs.columns
    expected = sorted(r.doc_id for r in mixing.document_copies(docs).collect() for _ in range(r.copies))
    assert sorted(r.doc_id for r in taken.collect()) == expected
    assert sorted(r.doc_id for r in mixing.mix(docs.repartition(7)).collect()) == expected


def test_empty_table_and_no_words(spark):
    assert mixing.document_copies(documents(spark, []).limit(0)).collect() == []
    assert mixing.mix(documents(spark, []).limit(0)).collect() == []
    rows = mixing.document_copies(documents(spark, [(1, None), (2, "")])).collect()
    assert {(r["size"], r.target, r.copies) for r in rows} == {(0, 0.0, 0)}
