from material import WORDS, awkward, documents, prose, words

from docledger.llm import decontaminate


def shingles(text, width):
    w = words((text or "").lower())
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def brute(docs, items, percent=80):
    out = set()
    for item, asked in items:
        n = min(5, len(words(asked)))
        if not n:
            continue
        own = shingles(asked, n)
        for doc, text in docs:
            shared = len(own & shingles(text, n))
            if shared and 100 * shared >= percent * len(own):
                out.add((doc, item, shared, len(own)))
    return out


def cases():
    items = [(i, prose(500 + i, 20 + i)) for i in range(25)]
    items += [(100, "only three words"), (101, "one"), (102, None), (103, ""), (104, "exactly five words are here"), (None, prose(900, 30))]
    docs = awkward()
    for i, (_, text) in enumerate(items[:25]):
        w = words(text)
        cut = w[: int(len(w) * (0.7 + 0.02 * i))] if i % 2 else w[:8] + ["other"] + w[9:]
        docs.append((1000 + i, prose(i, 200) + " " + " ".join(cut).upper() + "\n" + prose(i + 50, 100)))
    docs += [(2000, "he said only  three words today"), (2001, "one"), (2002, "exactly five words are\there"), (2003, items[-1][1] + " end")]
    docs += [(3000 + i, items[3][1] + " " + WORDS[i % 5]) for i in range(200)]
    return docs, items


def test_same_pairs_as_brute_force(spark):
    docs, items = cases()
    items_frame = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, doc_key int, hash string")
    found = decontaminate.contaminated(documents(spark, docs), items_frame)
    got = {(r.doc_id, r.item_id, r.shared, r.n_shingles) for r in found.collect()}
    expected = brute(docs, items)
    assert got == expected and len(expected) > 210
    held = {d for d, *_ in expected}
    left = decontaminate.without_contaminated(documents(spark, docs), items_frame)
    assert left.columns == documents(spark, docs).columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(i) for i, _ in docs if i not in held)


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    docs, items = cases()
    items_frame = spark.createDataFrame(items, "item_id long, text string")
    for bound in ("BROADCAST_ROWS", "BROADCAST_CANDIDATES", "BROADCAST_ITEMS"):
        monkeypatch.setattr(decontaminate, bound, 0)
    found = decontaminate.contaminated(documents(spark, docs), items_frame)
    assert {(r.doc_id, r.item_id, r.shared, r.n_shingles) for r in found.collect()} == brute(docs, items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    docs = documents(spark, awkward())
    assert decontaminate.contaminated(docs, none).collect() == []
    assert decontaminate.contaminated(docs.limit(0), some).collect() == []
    assert decontaminate.without_contaminated(docs, none).count() == len(awkward())
