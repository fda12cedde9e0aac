import hashlib
import random
import zlib

import pytest
from material import awkward, documents, prose
from pyspark.sql import functions as F

from docledger.llm import merkle, registry


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def climb(nodes, fan):
    """Root of a tree and per leaf its proof, level by level, by plain lists."""
    proofs = [[] for _ in nodes]
    of = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, above_of = [], []
        for low in range(0, len(nodes), fan):
            run = nodes[low : low + fan]
            for i, leaves in enumerate(of[low : low + fan]):
                for k in leaves:
                    proofs[k].append(("".join(run[:i]), "".join(run[i + 1 :])))
            above.append(h(run))
            above_of.append(sum(of[low : low + fan], []))
        nodes, of = above, above_of
    return nodes[0], proofs


def brute(rows, fan=3):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of rows (id, source, lang, n_chars, text)."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        own = sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = (own, *climb([leaf(r) for r in own], fan))
    root, above = climb([trees[s][1] for s in sources], fan)
    out = []
    for s, way in zip(sources, above, strict=True):
        own, subroot, proofs = trees[s]
        for r, proof in zip(own, proofs, strict=True):
            steps = proof + way
            touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and r[4] is not None
            at = leaf((*r[:4], r[4].replace("\n", "") if touched else r[4]))
            for before, after in steps:
                at = h([before, at, after])
            out.append((str(r[0]), leaf(r), subroot, root, h(a + b for a, b in steps), at, at == root))
    return sorted(out)


def table(spark, rows):
    kind = "doc_id long, source string, lang string, n_chars long, text string, idx string, tree string, digest string"
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], kind).repartition(3)


def told(found):
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in found)


def rows(seed, n):
    rng = random.Random(seed)
    sources = ["b", "a", None, "", "é", "\U0001f600", "￮", *["hot"] * 5]
    out = [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([None, 5]), prose(i, 3) + rng.choice(["", "\n", "\nx"])) for i in range(n)]
    return out + [(None, "a", None, None, None), (None, None, None, None, "\n"), (3, "a", None, 1, None), (3, "a", None, 1, None), (4, "b", "-", 1, "")]


@pytest.mark.parametrize("levels", [1, 2, 9])
@pytest.mark.parametrize("n", [1, 40, 300])
def test_matches_brute_force_in_any_blocks(spark, n, levels):
    given = rows(n, n)
    found = registry.manifest(table(spark, given), levels=levels).collect()
    assert told(found) == brute(given)
    assert any(r.verified for r in found) or n == 1


def test_every_size_of_a_tree(spark):
    given = [(i, f"s{k:02}", None, None, str(i)) for k in range(1, 31) for i in range(k)]
    assert told(registry.manifest(table(spark, given), levels=2).collect()) == brute(given)


def test_other_fan(spark):
    given = rows(5, 100)
    assert told(registry.manifest(table(spark, given), fan=2, levels=3).collect()) == brute(given, fan=2)


def test_awkward_documents(spark):
    docs = documents(spark, awkward()).withColumn("n_chars", F.length("text").cast("long"))
    given = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert told(registry.manifest(docs).collect()) == brute(given)


def test_a_changed_leaf_is_found(spark):
    given = [(i, "s", None, None, f"text {i}") for i in range(50)]
    found = merkle.row_proofs(table(spark, given), levels=2)
    wrong = found.withColumn("at", merkle.folded(F.sha2(F.lit("other"), 256), F.col("proof"))).where("at = root")
    assert wrong.count() == 0
    assert found.where(merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).count() == 50


def test_empty_table(spark):
    assert registry.manifest(table(spark, []).where("doc_id > 0")).collect() == []
