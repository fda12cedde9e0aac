import random
from collections import Counter, defaultdict

import pytest
from material import awkward, documents, prose, words

from docledger.llm import jaccard
from docledger.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def brute(rows, width, percent):
    sets = [shingles(t, width) for _, t in rows]
    where = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            where[x].append(i)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in where[x] if j > i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    members = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        members[find(i)].append(d)
    least = {k: min([d for d in v if d is not None], default=None) for k, v in members.items()}
    return [(d, len(sets[i]), least[find(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)]


def corpus():
    rng = random.Random(11)
    rows = awkward()
    for family in range(12):
        base = words(prose(700 + family, rng.choice([6, 12, 40, 150, 400])))
        for member in range(12):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 18))):
                w[rng.randrange(len(w))] = f"edit{rng.randint(0, 9999)}"
            rows.append((1000 + family * 50 + member, " ".join(w).upper() if member % 5 == 0 else " \n".join(w)))
    common = prose(3, 25)
    rows += [(5000 + i, common + " " + prose(9000 + i, 10 + i % 90)) for i in range(150)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("width", "percent", "orders"), [(4, 85, 2), (5, 80, 3)])
def test_same_components_as_brute_force(spark, width, percent, orders):
    rows = corpus()
    found = jaccard.jaccard_components(documents(spark, rows), width, percent, orders, bits=12)
    key = lambda r: tuple(str(x) for x in r)
    got = sorted([(r.doc_id, r.n_shingles, r.component_id) for r in found.collect()], key=key)
    assert got == sorted(brute(rows, width, percent), key=key)


def test_shuffled_texts_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BROADCAST_NODES", 0)
    rows = corpus()
    found = jaccard.jaccard_components(documents(spark, rows), bits=12)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in found.collect()], key=key) == sorted(brute(rows, 4, 85), key=key)


@pytest.mark.parametrize(("nodes", "shingles"), [(3, 10**9), (10**9, 200), (1, 1)])
def test_large_families_give_the_same(spark, monkeypatch, nodes, shingles):
    monkeypatch.setattr(jaccard, "FAMILY_NODES", nodes)
    monkeypatch.setattr(jaccard, "FAMILY_SHINGLES", shingles)
    rows = corpus()
    found = jaccard.jaccard_components(documents(spark, rows), bits=12)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in found.collect()], key=key) == sorted(brute(rows, 4, 85), key=key)


def test_words_that_fool_polynomials_are_told_apart(spark):
    word = "a"
    while len(word) < 1_024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, word + " x y z"), (4, other + " x y z"), (5, word * 3), (6, other * 3), (7, word.upper())]
    found = jaccard.jaccard_components(documents(spark, rows), bits=12).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(brute(rows, 4, 85))
    assert {r.component_id for r in found} == {1, 2, 3, 4, 5, 6}


def test_one_of_each(spark):
    rows = corpus()
    docs = documents(spark, rows)
    left = jaccard.one_of_each(docs)
    assert left.columns == docs.columns
    expected = Counter()
    for (d, t), (_, n, c) in zip(rows, brute(rows, 5, 80), strict=True):
        if not n or d == c:
            expected[d] = 1 if n else expected[d] + 1
    assert Counter(r.doc_id for r in left.collect()) == expected


def test_prefix_length_is_enough():
    for percent in (80, 85):
        for n in range(1, 400):
            shared_at_least = -(-percent * n // 100)
            assert jaccard.prefix_length(n, percent) == n - shared_at_least + 1


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(7, 7), (300, 200), (200, 300)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = {i: 100 for i in range(100, 161)} | {k: 1 for k in range(1, 40)} | {200: 200, 300: 200}
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty(spark):
    empty = documents(spark, []).limit(0)
    assert jaccard.jaccard_components(empty).collect() == []
    assert jaccard.one_of_each(empty).collect() == []
    blank = documents(spark, [(1, None), (2, ""), (3, " ")])
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(blank).collect()} == {(1, 0, 1), (2, 0, 2), (3, 0, 3)}


def test_counts_bound_what_sets_share():
    rng = random.Random(5)
    base = [jaccard.shingle_set(prose_bytes(rng.randrange(10**6), n), 5) for n in (6, 90, 700, 9_000)]
    sets = base + [s[rng.randrange(len(s)) // 3 :] for s in base]
    for a in sets:
        for b in sets:
            at_most = jaccard.shared_at_most(jaccard.bucket_counts(a), jaccard.bucket_counts(b))
            shared = len(set(a.tolist()) & set(b.tolist()))
            assert shared <= at_most <= min(len(a), len(b))
            if not shared and min(len(a), len(b)) > 50:
                assert at_most * 180 < (len(a) + len(b)) * 80
    crowded = jaccard.shingle_set(prose_bytes(1, 20_000), 5) << jaccard.np.uint64(12)
    assert jaccard.bucket_counts(crowded) == b""


def prose_bytes(seed, n):
    return jaccard.np.frombuffer(prose(seed, n).encode(), dtype=jaccard.np.uint8)


def test_only_pairs_that_counts_allow_are_joined_with_sets(spark, monkeypatch):
    base = words(prose(1, 300))
    rows = [(1, " ".join(base)), (2, " ".join([*base[:-3], "x", "y", "z"])), *[(10 + i, prose(50 + i, 300)) for i in range(20)]]
    docs = documents(spark, rows)
    nodes = {i: jaccard.digests(jaccard.shingle_set(jaccard.np.frombuffer(t.encode(), jaccard.np.uint8), 5))[0] for i, t in rows}
    known = docs.select("doc_id", jaccard.F.xxhash64("doc_id", "text").alias("row_id"))
    known = known.join(spark.createDataFrame(list(nodes.items()), "doc_id long, node long"), "doc_id").drop("doc_id")
    pairs = spark.createDataFrame([(nodes[a], nodes[b]) for a in nodes for b in nodes if a < b], "a long, b long")
    seen, plain = [], jaccard.checkpoint
    monkeypatch.setattr(jaccard, "checkpoint", lambda df: seen.append(plain(df)) or seen[-1])
    linked = jaccard._linked(pairs, docs, known, 5, 80)
    assert [tuple(r) for r in linked.collect()] == [(nodes[1], nodes[2])]
    assert [f.count() for f in seen if f.columns == ["a", "b"]] == [1, 1]


def test_a_common_passage_makes_no_family(spark, monkeypatch):
    """Unrelated texts that share a shingle under one order only are no family, where the sketch ranks nothing."""
    rows = [(i, prose(100 + i, 60) + " alphaed taued kappa deltaed gammaed") for i in range(40)]
    rows += [(90, prose(7, 80)), (91, prose(7, 80) + " end")]
    edges = []
    monkeypatch.setattr(jaccard, "frequency_classes", lambda sketches, bits: jaccard.np.zeros(1 << bits, dtype=jaccard.np.uint8))
    monkeypatch.setattr(jaccard, "components", lambda df: edges.append(df.count()) or components(df))
    found = jaccard.jaccard_components(documents(spark, rows), 5, 80, bits=4)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in found.collect()], key=key) == sorted(brute(rows, 5, 80), key=key)
    assert edges[0] == 1
