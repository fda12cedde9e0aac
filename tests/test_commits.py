import json

import pytest
from pyspark.sql import functions as F

from docledger.plans.models import Project, attach_published, drop_unpublished, published
from docledger.sources import commits, sinks
from docledger.sources.sinks import write_register


def frame(spark, n):
    return spark.range(n).withColumnRenamed("id", "v")


def test_a_claim_is_whole_and_never_replaced(spark, tmp_path):
    path = str(tmp_path / "deep" / "entry.json")
    assert commits.claim(spark, path, "first ä\n")
    assert not commits.claim(spark, path, "second\n")
    assert (tmp_path / "deep" / "entry.json").read_text() == "first ä\n"
    assert [p.name for p in (tmp_path / "deep").iterdir() if p.name.endswith(".tmp")] == []


def test_a_claim_by_rename(spark, tmp_path, monkeypatch):
    """The way of stores that are no local disk."""
    monkeypatch.setattr(commits, "_appear", commits._rename_once)
    path = str(tmp_path / "entry.json")
    assert commits.claim(spark, path, "first\n") and not commits.claim(spark, path, "second\n")
    assert (tmp_path / "entry.json").read_text() == "first\n"


def test_last_entry(spark, tmp_path):
    root = str(tmp_path / "t")
    assert commits.last_entry(spark, root) is None
    for n in (1, 2, 10):
        assert commits.claim_entry(spark, root, n, {"n": n})
    (tmp_path / "t" / "_log" / "notes.txt").write_text("x")
    assert commits.last_entry(spark, root) == (10, {"n": 10})


def broken(df):
    return df.select(F.raise_error(F.lit("broken")).cast("long").alias("v"))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_refresh_that_fails_leaves_the_table(spark, tmp_path, fmt):
    path = str(tmp_path / "table")
    write_register(frame(spark, 3), path, fmt)
    with pytest.raises(Exception, match="broken"):
        write_register(broken(frame(spark, 5)), path, fmt)
    assert spark.read.format(fmt).option("header", True).load(path).count() == 3
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["table"]
    write_register(frame(spark, 5), path, fmt)
    assert spark.read.format(fmt).option("header", True).load(path).count() == 5


def test_a_table_is_refreshed_from_itself(spark, tmp_path):
    path = str(tmp_path / "table")
    write_register(frame(spark, 3), path)
    write_register(spark.read.parquet(path).where("v > 0"), path)
    assert spark.read.parquet(path).count() == 2


def test_a_stop_between_the_two_renames_is_mended(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    write_register(frame(spark, 3), path)
    (tmp_path / "table").rename(tmp_path / ".table.old-1")
    assert commits.restore_folder(spark, path)
    assert spark.read.parquet(path).count() == 3
    (tmp_path / "table").rename(tmp_path / ".table.old-1")
    with pytest.raises(Exception, match="broken"):
        write_register(broken(frame(spark, 3)), path)
    assert spark.read.parquet(path).count() == 3


def test_what_cannot_move_into_place_moves_back(spark, tmp_path):
    path = str(tmp_path / "table")
    write_register(frame(spark, 3), path)
    with pytest.raises(Exception):
        commits.replace_folder(spark, str(tmp_path / "nowhere"), path)
    assert spark.read.parquet(path).count() == 3


def test_a_run_that_fails_half_way_leaves_the_last_good_tables(spark, tmp_path):
    root = str(tmp_path / "out")
    assert published(spark, root) == {}

    def project(second):
        made = Project()
        made.add("x", "one", ["raw.t"], lambda t: t)
        made.add("x", "two", ["s_x.one"], second)
        return made

    project(lambda t: t.where("v > 0")).run(spark, {"raw.t": frame(spark, 4)}, root)
    with pytest.raises(Exception, match="broken"):
        project(broken).run(spark, {"raw.t": frame(spark, 9)}, root)
    tables = published(spark, root)
    assert (tables["s_x.one"].count(), tables["s_x.two"].count()) == (4, 3)
    project(lambda t: t.where("v > 1")).run(spark, {"raw.t": frame(spark, 9)}, root)
    tables = published(spark, root)
    assert (tables["s_x.one"].count(), tables["s_x.two"].count()) == (9, 7)
    assert len(drop_unpublished(spark, root, older_than=0)) == 2
    assert published(spark, root)["s_x.two"].count() == 7
    entries = [json.loads(p.read_text()) for p in sorted((tmp_path / "out" / "_log").glob("*.json"))]
    assert [e["run"] for e in entries] == [1, 2]


def test_published_tables_have_sql_names_and_are_read_only(spark, tmp_path):
    root = str(tmp_path / "it's here")
    made = Project()
    made.add("y", "one", ["raw.t"], lambda t: t)
    made.run(spark, {"raw.t": frame(spark, 4)}, root)
    assert attach_published(spark, root) == ["s_y.one"]
    assert spark.sql("select count(*) from s_y.one").first()[0] == 4
    with pytest.raises(Exception, match="(?i)view|insert"):
        spark.sql("insert into s_y.one values (1)")
    made.run(spark, {"raw.t": frame(spark, 6)}, root)
    attach_published(spark, root)
    assert spark.table("s_y.one").count() == 6
    spark.sql("drop schema s_y cascade")


def test_sinks_keep_their_modes(spark, tmp_path):
    path = str(tmp_path / "table")
    sinks.write_register(frame(spark, 2), path, mode="ignore")
    sinks.write_register(frame(spark, 5), path, mode="ignore")
    assert spark.read.parquet(path).count() == 2
