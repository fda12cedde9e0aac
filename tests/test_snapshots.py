import hashlib
import threading
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import pytest

from docledger.operators import snapshots
from docledger.operators.lookup import enrich
from docledger.operators.snapshots import (
    drop_failed_writes,
    file_hashes,
    fingerprint,
    read_version,
    snapshot_diff,
    versions,
    write_version,
)
from docledger.sources.commits import claim_entry


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int")


def test_added_removed_modified(spark):
    old = frame(spark, [("a", 1), ("b", 2), ("c", 3), (None, 1)])
    new = frame(spark, [("b", 2), ("c", 4), ("d", 5), (None, 2)])
    changes = {r.k: r.change for r in snapshot_diff(old, new, ["k"]).collect()}
    assert changes == {"a": "Removed", "c": "Modified", "d": "Added", None: "Modified"}


def test_repeated_keys_do_not_multiply(spark):
    old = frame(spark, [("a", 1), ("a", 2)] * 5)
    new = frame(spark, [("a", 2), ("a", 1)] * 5)
    assert snapshot_diff(old, new, ["k"]).isEmpty()
    assert snapshot_diff(old, frame(spark, [("a", 1), ("a", 2)] * 4), ["k"]).count() == 1


def test_fingerprint_ignores_order_and_layout_only(spark):
    def digest(rows, parts=1):
        return fingerprint(frame(spark, rows).repartition(parts)).first().fingerprint

    base = [("a", 1), ("b", 2), ("b", 2), (None, None)]
    assert digest(base) == digest(base[::-1], 3)
    assert digest(base) != digest(base[1:])
    assert digest([("a", 1)] * 2) != digest([("b", 1)] * 2)
    assert digest(base) != digest([("a", 2), ("b", 1), ("b", 2), (None, None)])
    assert digest([]) == digest([])


def test_versioned_write(spark, tmp_path):
    root = str(tmp_path / "register")
    assert versions(spark, root).count() == 0
    assert write_version(frame(spark, [("a", 1)]), root, "first", "me") == 1
    assert write_version(frame(spark, [("a", 1)]), root, "same", "me") is None
    assert write_version(frame(spark, [("a", 2)]), root, "second", "me") == 2
    assert [r.message for r in versions(spark, root).collect()] == ["first", "second"]
    assert read_version(spark, root).first().v == 2
    assert read_version(spark, root, 1).first().v == 1


def test_versions_follow_numbers_not_clocks(spark, tmp_path):
    root = str(tmp_path / "register")
    for v in (1, 2):
        write_version(frame(spark, [("a", v)]), root, f"v{v}", "me")
    late = [(1, "x", "v1", "me", "2999-01-01 00:00:00")]
    spark.createDataFrame(late, "version long, file_hash string, message string, created_by string, created_at string").write.mode(
        "append"
    ).json(f"{root}/_log")
    assert write_version(frame(spark, [("a", 3)]), root, "v3", "me") == 3
    assert [read_version(spark, root, v).first().v for v in (1, 2, 3)] == [1, 2, 3]
    assert read_version(spark, root).first().v == 3


def test_nothing_is_overwritten_and_nothing_is_in_the_way(spark, tmp_path):
    root = str(tmp_path / "register")
    write_version(frame(spark, [("a", 1)]), root, "first", "me")
    frame(spark, [("left", 9)]).write.parquet(f"{root}/version=2")
    assert write_version(frame(spark, [("a", 2)]), root, "second", "me") == 2
    assert read_version(spark, root).first().v == 2
    assert spark.read.parquet(f"{root}/version=2").first().v == 9


class Stopped(Exception):
    pass


@pytest.mark.parametrize("place", ["before", "after"])
def test_a_writer_that_stops_at_the_log_blocks_nobody(spark, tmp_path, monkeypatch, place):
    root = str(tmp_path / "register")
    assert write_version(frame(spark, [("a", 1)]), root, "first", "me") == 1

    def stop(spark, root, number, entry):
        if place == "after":
            claim_entry(spark, root, number, entry)
        raise Stopped

    monkeypatch.setattr(snapshots, "claim_entry", stop)
    with pytest.raises(Stopped):
        write_version(frame(spark, [("a", 2)]), root, "second", "me")
    monkeypatch.undo()
    known = 1 if place == "before" else 2
    assert versions(spark, root).count() == known and read_version(spark, root).first().v == known
    assert write_version(frame(spark, [("a", 3)]), root, "third", "me") == known + 1
    assert read_version(spark, root).first().v == 3
    assert len(drop_failed_writes(spark, root, older_than=3600)) == 0
    assert len(drop_failed_writes(spark, root, older_than=0)) == (1 if place == "before" else 0)
    assert [read_version(spark, root, v).count() for v in range(1, known + 2)] == [1] * (known + 1)


def test_a_write_that_stops_in_its_data_blocks_nobody(spark, tmp_path):
    root = str(tmp_path / "register")
    write_version(frame(spark, [("a", 1)]), root, "first", "me")
    (tmp_path / "register" / "data" / "half").mkdir()
    (tmp_path / "register" / "data" / "half" / "part-0.parquet").write_bytes(b"cut")
    (tmp_path / "register" / "_log" / ".left.tmp").write_bytes(b'{"vers')
    assert write_version(frame(spark, [("a", 2)]), root, "second", "me") == 2
    assert [r.version for r in versions(spark, root).collect()] == [1, 2]


def test_writers_at_once_get_numbers_of_their_own(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "register")
    writers = 4
    meet = threading.Barrier(writers)
    first = set()

    def together(spark, root, number, entry):
        if threading.get_ident() not in first:
            first.add(threading.get_ident())
            meet.wait(timeout=120)
        return claim_entry(spark, root, number, entry)

    monkeypatch.setattr(snapshots, "claim_entry", together)
    frames = [frame(spark, [("a", i)]) for i in range(writers)]
    with ThreadPoolExecutor(writers) as pool:
        numbers = list(pool.map(lambda f: write_version(f, root, "x", "me"), frames))
    assert sorted(numbers) == list(range(1, writers + 1))
    assert [r.version for r in versions(spark, root).collect()] == list(range(1, writers + 1))
    assert {n: read_version(spark, root, n).first().v for n in numbers} == dict(zip(numbers, range(writers), strict=True))


def test_the_loser_of_a_claim_with_equal_content_writes_nothing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "register")
    same = frame(spark, [("a", 1)])

    def beaten(spark, root, number, entry):
        monkeypatch.undo()
        assert write_version(same, root, "other", "you") == 1
        return claim_entry(spark, root, number, entry)

    monkeypatch.setattr(snapshots, "claim_entry", beaten)
    assert write_version(same, root, "mine", "me") is None
    assert [r.message for r in versions(spark, root).collect()] == ["other"]
    assert len(list((tmp_path / "register" / "data").iterdir())) == 1


def test_unknown_versions_are_an_error(spark, tmp_path):
    root = str(tmp_path / "register")
    write_version(frame(spark, [("a", 1)]), root, "first", "me")
    with pytest.raises(ValueError, match="no version 7"):
        read_version(spark, root, 7)


def test_an_unreadable_log_is_no_empty_log(spark, tmp_path):
    root = tmp_path / "register"
    write_version(frame(spark, [("a", 1)]), str(root), "first", "me")
    (root / "_log" / "part-broken.json").write_text("{not json\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        write_version(frame(spark, [("a", 2)]), str(root), "second", "me")
    assert len(list((root / "data").iterdir())) == 1


def test_equal_maps_are_equal_in_any_order(spark):
    kind = "k int, m map<string,map<string,int>>, a array<map<string,int>>"
    old = spark.createDataFrame([(1, {"x": {"p": 1, "q": 2}, "y": {}}, [{"a": 1, "b": 2}]), (2, None, None), (3, {}, [])], kind)
    new = spark.createDataFrame([(1, {"y": {}, "x": {"q": 2, "p": 1}}, [{"b": 2, "a": 1}]), (2, None, None), (3, {}, [])], kind)
    assert snapshot_diff(old, new, ["k"]).isEmpty()
    assert fingerprint(old).first() == fingerprint(new).first()
    other = spark.createDataFrame([(1, {"y": {}, "x": {"q": 2, "p": 9}}, [{"b": 2, "a": 1}]), (2, {}, None), (3, None, [])], kind)
    assert {r.k for r in snapshot_diff(old, other, ["k"]).collect()} == {1, 2, 3}


def test_snapshot_diff_has_one_exchange(spark):
    plan = snapshot_diff(frame(spark, [("a", 1)]), frame(spark, [("a", 1)]), ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_file_hashes(spark, tmp_path):
    (tmp_path / "a.sql").write_text("select 1")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.sql").write_text("select 2")
    before = file_hashes(spark, str(tmp_path), "*.sql")
    kept = spark.createDataFrame(before.collect(), before.schema)
    (tmp_path / "sub" / "b.sql").write_text("select 3")
    changed = snapshot_diff(kept, file_hashes(spark, str(tmp_path), "*.sql"), ["path"]).collect()
    assert [(r.path.rsplit("/", 1)[-1], r.change) for r in changed] == [("b.sql", "Modified")]


def tree(data, width):
    """The hash of a file by plain lists."""
    lines = data.split(b"\n")
    level = [hashlib.md5(line).hexdigest() for line in (lines[:-1] if data.endswith(b"\n") else lines)] if data else []
    while len(level) > 1:
        level = [hashlib.md5("".join(level[i : i + width]).encode()).hexdigest() for i in range(0, len(level), width)]
    return hashlib.md5(f"{len(data)}:{level[0] if level else ''}".encode()).hexdigest()


def test_file_hashes_are_trees_of_blocks(spark, tmp_path):
    contents = {
        "one": b"x", "ended": b"x\n", "blank": b"\n\n", "raw": bytes(range(256)) * 3,
        "long": b"".join(b"line %d\r\n" % i for i in range(700)), "exact": b"a\n" * 49, "more": b"a\n" * 50,
    }
    for name, data in contents.items():
        (tmp_path / f"{name} ü.txt").write_bytes(data)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("128MB", "300b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        found = {unquote(r.path).rsplit("/", 1)[1].split(" ")[0]: r.hash for r in file_hashes(spark, str(tmp_path), block_lines=7).collect()}
        assert found == {name: tree(data, 7) for name, data in contents.items()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(set(found.values())) == len(contents)
    (tmp_path / "none.txt").write_bytes(b"")
    assert file_hashes(spark, str(tmp_path)).count() == len(contents)


def test_lookup_keeps_one_row_per_key(spark):
    lines = spark.createDataFrame([("count", 1), ("box", 2), ("none", 3)], "uom string, n int")
    lookup = spark.createDataFrame([("count", "NOS"), ("count", "NOSS"), ("box", "BOX")], "u string, g string")
    rows = sorted((r.n, r.unit) for r in enrich(lines, lookup, {"uom": "u"}, {"g": "unit"}).collect())
    assert rows == [(1, "NOS"), (2, "BOX"), (3, None)]
    with pytest.raises(ValueError, match="repeats"):
        enrich(lines, lookup, {"uom": "u"}, {"g": "unit"}, duplicates="fail")
