import hashlib
import random

import numpy as np
from material import awkward, documents, prose
from pyspark.sql import functions as F

from docledger.llm import recipes


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((str(i), str(keep), len(ids), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out)


def told(found):
    return sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in found)


def check(rows, found):
    assert told(found) == brute(rows)
    kept = [r for r in found if r.kept]
    assert len(kept) == len({t or "" for _, t in rows})
    assert all(r.doc_id == r.keep_id for r in kept)


def texts():
    long = prose(7, 30_000)
    shifted = "x" + long
    swapped = long[:100_000] + long[50_000:100_000] + long[100_000:]
    rows = awkward() + [(100, long), (101, shifted), (102, long), (103, swapped), (104, long[:-1]), (105, "a" * 200_000)]
    return rows + [(106, "a" * 200_000), (107, "a" * 199_999), (None, long), (None, ""), (5, "")]


def test_matches_brute_force(spark):
    rows = texts()
    check(rows, recipes.equal_texts(documents(spark, rows)).collect())


def test_colliding_digests_are_refused(spark):
    """A digest of one byte collides; only the second seed has a sound one."""

    def weak(chunk, seed):
        return recipes.strong_digest(chunk, seed) if seed else bytes([len(bytes(chunk)) % 7])

    rows = texts()
    check(rows, recipes.equal_texts(documents(spark, rows), digest=weak).collect())


def test_small_chunks_and_normalised_texts(spark):
    rows = [(1, "A b"), (2, "a B"), (3, "a b c"), (4, None), (5, " ")] + [(10 + i, "Same " * 500) for i in range(20)]
    found = recipes.equal_texts(documents(spark, rows), normalise=lambda t: F.trim(F.lower(t)), sizes=(32, 64, 128)).collect()
    check([(i, (t or "").lower().strip(" ")) for i, t in rows], found)


def test_cuts_follow_content_and_segments_do_not_matter(monkeypatch):
    rng = random.Random(1)
    body = np.frombuffer(bytes(rng.randrange(256) for _ in range(200_000)), dtype=np.uint8)
    whole = recipes.cut_hints(body)
    assert len(whole) > 50
    monkeypatch.setattr(recipes, "SEGMENT", 1_000)
    assert recipes.cut_hints(body) == whole
    monkeypatch.undo()

    def pieces(data):
        ends = recipes.chunk_ends(recipes.cut_hints(data), 0, len(data))
        return [data[a:b].tobytes() for a, b in zip([0, *ends], ends, strict=False)]

    a = pieces(body)
    b = pieces(np.concatenate((np.frombuffer(b"some bytes before", dtype=np.uint8), body)))
    assert b"".join(a) == body.tobytes()
    assert all(recipes.LEAST <= len(p) <= recipes.MOST for p in a[:-1])
    assert len(set(a) & set(b)) >= len(a) - 3


def test_same_cuts_behind_other_texts(spark):
    rows = [(i, prose(i, 40)) for i in range(60)] + [(1000 + i, prose(5_000, 3_000)) for i in range(3)]
    for parts in (1, 7):
        found = recipes.chunk_recipes(documents(spark, rows, parts)).where("doc_id >= 1000").select("recipe").distinct().collect()
        assert len(found) == 1 and len(found[0].recipe) > 2 * recipes.DIGEST_BYTES


def test_empty_table(spark):
    assert recipes.equal_texts(documents(spark, [])).collect() == []
