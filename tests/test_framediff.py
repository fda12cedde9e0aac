import pytest

from docledger.operators.framediff import frame_diff, frames_equal, header_difference, side_by_side, split_columns


def frame(spark, rows, schema="k int, v string, n int"):
    return spark.createDataFrame(rows, schema)


def test_keyed_diff(spark):
    left = frame(spark, [(1, "a", 1), (2, "b", None), (3, "c", 3)])
    right = frame(spark, [(2, "b", 5), (1, "x", 1), (4, "c", 3)])
    cells = sorted(map(tuple, frame_diff(left, right, key=["k"]).collect()))
    assert cells == [(1, "v", "a", "x"), (2, "n", None, "5")]


def test_positional_diff(spark):
    left = frame(spark, [(1, "a", 1), (2, "b", 2)])
    right = frame(spark, [(1, "a", 1), (3, "b", 2)])
    cells = frame_diff(left, right, order_by=["k"], include=["k", "v"]).collect()
    assert [tuple(c) for c in cells] == [(2, "k", "2", "3")]


def test_rows_beyond_the_shorter_frame_differ(spark):
    left = frame(spark, [(1, "a", 1), (2, "b", None)])
    right = frame(spark, [(1, "a", 1)])
    cells = sorted(map(tuple, frame_diff(left, right, order_by=["k"]).collect()), key=str)
    assert cells == [(2, "k", "2", None), (2, "n", None, None), (2, "v", "b", None)]
    assert sorted(r.left_value or "-" for r in frame_diff(right, left, order_by=["k"]).collect()) == ["-", "-", "-"]


def test_repeated_or_null_keys_never_multiply(spark):
    for key in (1, None):
        rows = frame(spark, [(key, "a", 1), (key, "b", 2)])
        with pytest.raises(ValueError, match="repeated k on the left"):
            frame_diff(rows, rows, key=["k"])
        assert frames_equal(rows, rows, key=["k"], order_by=["n"])
    one = frame(spark, [(None, "a", 1)])
    assert frames_equal(one, one, key=["k"])


def test_repeated_keys_pair_by_place(spark):
    left = frame(spark, [(1, "a", 1), (1, "b", 2), (2, "z", 1)])
    right = frame(spark, [(1, "a", 1), (1, "c", 2), (1, "d", 3), (2, "z", 1)])
    cells = frame_diff(left, right, key=["k"], order_by=["n"]).collect()
    assert [tuple(c) for c in cells] == [(1, 2, "v", "b", "c")]


def test_verdicts(spark):
    a = frame(spark, [(1, "a", 1), (2, "b", 2)])
    b = frame(spark, [(2, "b", 2), (1, "a", 9)])
    empty = frame(spark, [])
    assert frames_equal(empty, empty, key=["k"])
    assert not frames_equal(a, empty, key=["k"])
    assert frames_equal(a, a, key=["k"])
    assert not frames_equal(a, b, key=["k"])
    assert frames_equal(a, b, key=["k"], ignore=["n"])
    assert frames_equal(a, b, order_by=["k"], include=["k", "v"])
    assert not frames_equal(a, b.drop("v"), key=["k"])
    assert not frames_equal(a, b.limit(1), key=["k"])


def test_positional_compare_needs_an_order(spark):
    a = frame(spark, [(1, "a", 1)])
    with pytest.raises(ValueError):
        frame_diff(a, a)


ARRAYS = "k int, a array<int>"


@pytest.mark.parametrize(
    ("left", "right", "ordered_equal", "unordered_equal"),
    [
        ([1, 2], [1, 2], True, True),
        ([1, 2], [2, 1], False, True),
        ([1, 2], [1, 3], False, False),
        ([1, 1, 2], [1, 2, 2], False, False),
        ([], None, False, True),
        (None, None, True, True),
        ([1], None, False, False),
    ],
)
def test_arrays(spark, left, right, ordered_equal, unordered_equal):
    a, b = frame(spark, [(1, left)], ARRAYS), frame(spark, [(1, right)], ARRAYS)
    assert frame_diff(a, b, key=["k"]).isEmpty() is ordered_equal
    assert frame_diff(a, b, key=["k"], ordered_arrays=False).isEmpty() is unordered_equal


def test_column_kinds_and_headers(spark):
    df = frame(spark, [], "k int, a array<int>, v string")
    assert split_columns(df) == (["a"], ["k", "v"])
    assert header_difference(df, df.drop("v")) == {"v"}


def test_side_by_side(spark):
    left = frame(spark, [(1, "a", 1), (1, "b", 2), (2, "c", 1)])
    right = frame(spark, [(1, "x", 5), (3, "y", 1)])
    rows = [r.asDict() for r in side_by_side(left, right, "k", ["n"]).collect()]
    assert rows == [{
        "Key": 1, "ordinal": 1, "left_k": 1, "left_v": "a", "left_n": 1, "right_k": 1, "right_v": "x", "right_n": 5,
    }]
