import hashlib
from collections import Counter

import pytest
from material import awkward, documents, prose, words

from docledger.llm import substrings


def brute(rows, window=35):
    split = [(d, words(t)) for d, t in rows]
    seen = Counter(tuple(w[i : i + window]) for _, w in split for i in range(len(w) - window + 1))
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(d), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


def corpus():
    passage, short = prose(99, 60), prose(98, 34)
    rows = awkward() + [(100, prose(12, 37)), (101, prose(12, 37) + " end"), (102, "x " * 36), (103, "p " + "q r " * 60)]
    rows += [(200 + i, prose(300 + i, i % 9) + " " + passage + ("\n\n" if i % 2 else " ") + prose(600 + i, i % 23)) for i in range(60)]
    rows += [(300 + i, short + f" tail{i} " + prose(i, 20)) for i in range(20)]
    return rows


@pytest.mark.parametrize("hot", [5_000, 3, 0])
def test_same_words_go_as_by_brute_force(spark, hot):
    rows = corpus()
    found = substrings.without_repeats(documents(spark, rows), hot=hot, with_text=True).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in found) == brute(rows)


def test_words_that_fool_polynomials_are_told_apart(spark):
    """Thue-Morse words and their complements have one polynomial hash, whatever its odd multiplier."""
    word = "a"
    while len(word) < 1_024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{word} {rest}"), (2, f"{other} {rest}"), (3, f"{word} {rest} x"), (4, f"{other * 2} {rest}"), (5, f"{word * 2} {rest}")]
    found = substrings.without_repeats(documents(spark, rows), with_text=True).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in found) == brute(rows)


def test_texts_cross_batches(spark):
    rows = [(i, prose(i % 40, 50) + " " + prose(1000 + i, 30)) for i in range(160)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = substrings.without_repeats(documents(spark, rows), with_text=True).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in found) == brute(rows)


def test_minimisers_are_the_least_of_their_windows():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (34, 35, 36, 70, 200):
        hashes = rng.integers(0, 1 << 63, n).astype(np.uint64)
        least, seeds = substrings.minimisers(hashes, 35, 8)
        assert [int(x) for x in least] == [int(seeds[i : i + 28].min()) for i in range(n - 34)]


def test_empty(spark):
    assert substrings.without_repeats(documents(spark, []).limit(0)).collect() == []
