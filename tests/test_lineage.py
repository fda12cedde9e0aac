import json

from pyspark.sql import functions as F

from docledger.operators import lineage
from docledger.operators.lineage import Project, downstream, matching_rows, trace, upstream, walk
from docledger.session import checkpoint

PARENTS = {"s.register": ["s.export", "raw.lines"], "s.export": ["raw.lines"]}


def test_walk_visits_once_depth_first():
    assert walk(PARENTS, "s.register") == [("s.register", 0), ("s.export", 1), ("raw.lines", 2)]
    assert walk({"a": ["b"], "b": ["a"]}, "a") == [("a", 0), ("b", 1)]


def test_upstream_takes_the_shortest_path_and_ends_on_cycles(spark):
    edges = spark.createDataFrame(
        [("a", "b"), ("b", "c"), ("a", "c"), ("c", "a"), ("c", "d"), ("x", "y"), ("a", "b")], "child string, parent string"
    )
    starts = spark.createDataFrame([("a",), ("x",), ("lone",)], "node string")
    reached = {(r.start, r.node): r.depth for r in upstream(edges, starts).collect()}
    assert reached == {
        ("a", "a"): 0, ("a", "b"): 1, ("a", "c"): 1, ("a", "d"): 2, ("x", "x"): 0, ("x", "y"): 1, ("lone", "lone"): 0,
    }


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """A chain of a thousand with a short cut, a cycle and a fork in it."""
    pairs = [(f"n{i}", f"n{i + 1}") for i in range(1000)] + [("n10", "n400"), ("n700", "n650"), ("n5", "m0"), ("m0", "m1"), ("n7", "n7")]
    edges = spark.createDataFrame(pairs, "child string, parent string")
    starts = spark.createDataFrame([("n0",), ("n999",), ("m1",)], "node string")
    kept = []
    monkeypatch.setattr(lineage, "checkpoint", lambda df: kept.append(df) or checkpoint(df))
    reached = {(r.start, r.node): r.depth for r in upstream(edges, starts).collect()}
    assert len(kept) <= 22
    graph, expected = {}, {}
    for child, parent in pairs:
        graph.setdefault(child, []).append(parent)
    for start in ("n0", "n999", "m1"):
        level, depth = {start}, 0
        while level:
            expected |= {(start, n): depth for n in level}
            level = {p for n in level for p in graph.get(n, ())} - {n for s, n in expected if s == start}
            depth += 1
    assert reached == expected and reached["n0", "n1000"] == 611


def test_nothing_to_walk(spark):
    none = spark.createDataFrame([], "child string, parent string")
    starts = spark.createDataFrame([("a",), ("a",)], "node string")
    assert [tuple(r) for r in upstream(none, starts).collect()] == [("a", "a", 0)]
    assert upstream(none, starts.where("node = 'b'")).collect() == []


def test_project_manifest(spark):
    manifest = {
        "nodes": {"model.a": {"schema": "sale", "name": "register"}, "model.b": {"schema": "sale", "name": "export"}},
        "sources": {"source.c": {"schema": "raw", "name": "lines"}},
        "parent_map": {"model.a": ["model.b", "source.c"], "model.b": ["source.c"], "source.c": []},
        "child_map": {"source.c": ["model.a", "model.b"], "model.b": ["model.a"], "model.a": []},
    }
    project = Project.from_manifest(json.dumps(manifest))
    assert project.tables == {"model.a": "sale.register", "model.b": "sale.export", "source.c": "raw.lines"}
    starts = spark.createDataFrame([("source.c",)], "node string")
    reached = {r.node: r.depth for r in downstream(project.edges(spark), starts).collect()}
    assert reached == {"source.c": 0, "model.a": 1, "model.b": 1}
    assert {n for n, _ in walk(project.children, "source.c")} == set(reached)


def tables(spark):
    return {
        "s.register": spark.createDataFrame([("7", "x"), ("8", None), ("7", "x")], "`Document Number` string, v string"),
        "s.export": spark.createDataFrame([("1", "7"), ("7", "2"), ("7", "7"), ("3", "3")], "VBELN string, AWKEY string"),
        "raw.lines": spark.createDataFrame([("p",), ("q",)], "part string"),
    }


def test_trace_one_number(spark):
    rows = trace(tables(spark), PARENTS, "s.register", "7").collect()
    assert sorted((r.visit, r.table, r.depth) for r in rows) == (
        [(0, "s.register", 0)] * 2 + [(1, "s.export", 1)] * 3 + [(2, "raw.lines", 2)] * 2
    )
    assert json.loads(next(r.row for r in rows if r.visit == 0)) == {"Document Number": "7", "v": "x"}


def test_wide_rows_move_once(spark):
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        wide = spark.range(50).select(
            *[F.when(F.col("id") % (i + 2) == 0, F.col("id").cast("string")).alias(c) for i, c in enumerate(lineage.TRACE_KEYS)],
            F.md5(F.col("id").cast("string")).alias("wide"),
        )
        numbers = spark.range(10).select(F.col("id").cast("string").alias("number"))
        rows = matching_rows(wide, numbers)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(coalesce(__place") == 1
        assert plan.count("Exchange") <= 6 and plan.count("Scan") + plan.count("Range") <= 3
        expected = [r for r in wide.collect() if any(r[c] is not None and int(r[c]) < 10 for c in lineage.TRACE_KEYS)]
        assert sorted(map(str, rows.collect())) == sorted(map(str, expected))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_trace_many_numbers_keeps_each_row_once(spark):
    numbers = spark.createDataFrame([("7",), ("8",), ("7",), (None,)], "number string")
    frames = tables(spark)
    assert matching_rows(frames["s.register"], numbers).count() == 3
    assert matching_rows(frames["s.export"], numbers).count() == 3
    assert matching_rows(frames["raw.lines"], numbers).count() == 2
    assert trace(frames, PARENTS, "s.export").count() == 6


def test_many_numbers_sort_no_rows(spark, monkeypatch):
    """Rows of one key column go straight to the numbers; many numbers are hashed, never the rows sorted."""
    monkeypatch.setattr(lineage, "FEW_NUMBERS", 2, raising=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbers = spark.createDataFrame([("7",), ("8",), ("3",), ("7",), (None,)], "number string")
        frames = tables(spark) | {"one": spark.createDataFrame([("7", 1), ("7", 1), (None, 2), ("9", 3)], "BELNR string, v int")}
        one, several = matching_rows(frames["one"], numbers), matching_rows(frames["s.export"], numbers)
        assert [tuple(r) for r in one.collect()] == [("7", 1)] * 2
        assert sorted(map(tuple, several.collect())) == [("1", "7"), ("3", "3"), ("7", "2"), ("7", "7")]
        plans = [df._jdf.queryExecution().optimizedPlan().toString() for df in (one, several)]
        assert [p.count("Join LeftSemi") for p in plans] == [1, 2]
        physical = [df._jdf.queryExecution().sparkPlan().toString() for df in (one, several)]
        assert all("SortMergeJoin" not in p for p in physical)
        assert trace(frames, {"one": []}, "one", numbers).count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
