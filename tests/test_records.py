import random

import pytest

from docledger.sources import files
from docledger.sources import records as rec


@pytest.fixture
def small_ranges(spark):
    """Files are cut into ranges of a few hundred bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "256b", "spark.sql.files.openCostInBytes": "1b", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def cell(rng):
    kind = rng.randrange(9)
    plain = "".join(rng.choice("abc xyzäß😀") for _ in range(rng.randrange(1, 12)))
    if kind < 4:
        return plain
    if kind == 4:
        return f'"{plain}"'
    if kind == 5:
        return '"' + plain + "\n" * rng.randrange(1, 4) + 'and, ""more""' + "\n" + plain + '"'
    if kind == 6:
        return f'a"{plain}" b'  # a quote that does not open a cell
    if kind == 7:
        return '"' + "line\r\n" * rng.randrange(0, 60) + '"'
    return '"""",""'.replace(",", "") + plain if rng.random() < 0.5 else '""""'


def table(seed, n, end="\n", columns=3):
    rng = random.Random(seed)
    lines = [",".join(f"c{i}" for i in range(columns))]
    lines += [",".join(cell(rng) for _ in range(columns)) for _ in range(n)]
    return end.join(lines) + (end if rng.random() < 0.7 else "")


def plain_read(spark, path, headers):
    """One task a file: the rows to match. In files that end lines in CR LF it turns quoted ones into LF."""
    raw = spark.read.option("columnPruning", "false").csv(
        path, schema=", ".join(f"{h} string" for h in headers), header=True, mode="FAILFAST", multiLine=True, quote='"', escape='"'
    )
    return sorted(map(tuple, raw.collect()), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", range(4))
def test_rows_of_ranges_are_those_of_whole_files(spark, tmp_path, small_ranges, seed, end):
    headers = ["c0", "c1", "c2"]
    for k in range(3):
        (tmp_path / f"f{k}.csv").write_bytes(table(seed * 10 + k, 60, end).encode())
    path = str(tmp_path)
    assert rec.lines_of(spark, path).select("path", "start").distinct().count() > 20
    whole = rec.records_of(rec.lines_of(spark, path), ",", headers)
    found = files.text_cells(whole, headers, ",").collect()
    if end == "\r\n":
        assert any("\r\n" in c for r in found for c in r if c)
        found = [tuple(c and c.replace("\r\n", "\n") for c in r) for r in found]
    assert sorted(map(tuple, found), key=str) == plain_read(spark, path, headers)


def test_a_cell_over_many_ranges(spark, tmp_path, small_ranges):
    long = "\n".join(f"line {i}" for i in range(400))
    (tmp_path / "a.csv").write_text(f'x,y\n1,"{long}"\n2,"b\n\nb"\n3,c\n')
    found = sorted(map(tuple, files.read_strings(spark, str(tmp_path), ["x", "y"]).collect()))
    assert found == [("1", long), ("2", "b\n\nb"), ("3", "c")]
    assert rec.lines_of(spark, str(tmp_path)).select("start").distinct().count() > 10


def test_one_file_spreads_over_tasks(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text("x,y\n" + '1,"a\nb"\n' * 2_000)
    frame = files.read_strings(spark, str(tmp_path), ["x", "y"])
    assert frame.rdd.getNumPartitions() > 40
    assert frame.distinct().collect() == [("1", "a\nb")] and frame.count() == 2_000


def test_bare_carriage_returns_stay(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"x,y\n1,a\rb\n2,c\n")
    assert sorted(map(tuple, files.read_strings(spark, str(tmp_path), ["x", "y"]).collect())) == [("1", "a\rb"), ("2", "c")]


def test_torn_rows_and_other_headers_fail(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text('x,y\n1,"a\nb"\n2,c,d\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_strings(spark, str(tmp_path), ["x", "y"]).collect()
    (tmp_path / "a.csv").write_text('x,z\n1,"a\nb"\n')
    with pytest.raises(Exception, match="expected"):
        files.read_strings(spark, str(tmp_path), ["x", "y"]).collect()


def test_ranges_cut_anew_between_passes_are_an_error(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text("x,y\n" + '1,"a\nb"\n' * 400)
    frame = rec.records_of(rec.lines_of(spark, str(tmp_path)), ",", ["x", "y"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "199b")
    with pytest.raises(Exception, match="cut anew"):
        frame.select("text").collect()


def test_unclosed_quote_takes_the_rest(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_text('x,y\n1,a\n2,"b\n' + "more\n" * 200)
    path = str(tmp_path)
    found = files.text_cells(rec.records_of(rec.lines_of(spark, path), ",", ["x", "y"]), ["x", "y"], ",").collect()
    assert len(found) == 2 and sum("more" in (r.y or "") for r in found) == 1


def input_bytes(spark, work):
    """Bytes that the tasks of ``work`` read from files."""
    store = spark.sparkContext._jsc.sc().statusStore()
    seen = {s.stageId() for s in _stages(spark, store)}
    result = work()
    return result, sum(s.inputBytes() for s in _stages(spark, store) if s.stageId() not in seen)


def _stages(spark, store):
    jvm = spark._jvm
    found = store.stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return [found.apply(i) for i in range(found.size())]


def test_headers_cost_the_same_for_any_size(spark, tmp_path):
    sizes = {}
    for name, rows in (("small", 50_000), ("large", 2_000_000)):
        path = tmp_path / f"{name}.csv"
        path.write_text('a,"b\nc"\n' + "1,2\n" * rows)
        record, read = input_bytes(spark, lambda path=path: rec.first_records(spark, [str(path)]))
        assert list(record.values()) == ['a,"b\nc"']
        sizes[name] = read
    assert sizes["large"] <= 2 * sizes["small"] + 300_000


@pytest.mark.parametrize("text, expected", [("", ""), ("\n\na,b\n", "a,b"), ('"a\r\nb",c', '"a\r\nb",c'), ("a,b", "a,b")])
def test_first_records(spark, tmp_path, text, expected):
    (tmp_path / "f 1.csv").write_bytes(text.encode())
    path = str(tmp_path / "f 1.csv")
    assert rec.first_records(spark, [path])[path].replace("\r\n", "\n") == expected.replace("\r\n", "\n")


@pytest.mark.parametrize(
    "line, whole",
    [
        ('"",b', True), ('"a,b","c""d"', True), ('a""b,c', True), ('"""",""""""', True), ('"a"\r', True),
        ('a"b,c', False), ('"a,b', False), (',""",b', False), ('"a"b,c', False), ('x"y,"z', False), ('"x,"y","z', False), ('"a\rb"', False),
    ],
)
def test_lines_whose_quotes_end_with_them(spark, line, whole):
    assert rec.line_use(spark.createDataFrame([(line,), ("a,b",)], "value string"), ",") == (True, whole)
    assert rec.line_use(spark.createDataFrame([(line.replace(",", "|"),)], "value string"), "|")[1] == whole
    assert not whole or not rec.Quoting(",").after(line.removesuffix("\r"), False)


def test_blank_lines_beside_quotes_are_no_records_of_lines(spark):
    lines = [spark.createDataFrame([(a,), (b,)], "value string") for a, b in (("a,b", " "), ('"a",b', " "), ('"a",b', ""))]
    assert [rec.line_use(x, ",") for x in lines] == [(False, True), (True, False), (True, True)]


def test_quoted_cells_within_lines_are_read_without_python(spark, tmp_path, small_ranges):
    text = 'x,"y,z"\n' + "".join(f'{i},"a, ""b"" {i}"\n{i},""\n' for i in range(300))
    (tmp_path / "a.csv").write_text(text)
    for frame in (files.read_delimited(spark, str(tmp_path)), files.read_strings(spark, str(tmp_path), ["x", "y,z"])):
        assert "MapInArrow" not in frame._jdf.queryExecution().toString()
        assert frame.columns == ["x", "y,z"] and frame.rdd.getNumPartitions() > 10
        want = [(str(i), y) for i in range(300) for y in (f'a, "b" {i}', None)]
        assert sorted(map(tuple, frame.collect()), key=str) == sorted(want, key=str)
    (tmp_path / "b.csv").write_text('x,"y"\n1,"a"\n')
    with pytest.raises(Exception, match="(?i)header"):
        files.read_strings(spark, str(tmp_path), ["x", "y,z"]).collect()
