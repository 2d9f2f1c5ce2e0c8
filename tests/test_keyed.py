from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tarmac.operators import keyed
from tarmac.operators.dimensions import coded_rows

SCHEMA = "a string, b int, seq int, v string"
ROWS = st.lists(
    st.tuples(
        st.sampled_from(["x", "y", None]),
        st.sampled_from([1, None]),
        st.integers(0, 4) | st.none(),
        st.text("pq", max_size=2),
    ),
    max_size=12,
)
FEW = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
KEYS = ["a", "b"]


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def rank(row):
    return tuple((value is not None, value) for value in row[2:])


def last_per_key(rows):
    best = {}
    for row in rows:
        if row[:2] not in best or rank(row) > rank(best[row[:2]]):
            best[row[:2]] = row
    return sorted(best.values(), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@FEW
@given(rows=ROWS)
def test_latest_per_key(spark, rows):
    df = frame(spark, rows)
    assert result(keyed.latest_per_key(df, KEYS, ["seq"])) == last_per_key(rows)


@FEW
@given(rows=ROWS, cut=st.integers(0, 12))
def test_upsert_does_not_depend_on_the_split(spark, rows, cut):
    """With one value per sequence number, so that no tie has to be broken."""
    rows = [(a, b, seq, f"v{seq}") for a, b, seq, _ in rows if seq is not None]
    merged = frame(spark, [])
    for part in (rows[:cut], rows[cut:], rows[:cut]):
        merged = keyed.upsert(merged, frame(spark, part), KEYS, ["seq"])
    assert result(merged) == last_per_key(rows)


def test_plain_upsert_replaces_and_never_deletes(spark):
    target = frame(spark, [("x", 1, 9, "old"), ("y", 1, 9, "stays"), (None, None, 9, "old")])
    source = frame(spark, [("x", 1, 1, "new"), (None, None, 1, "new"), ("z", None, 1, "added")])
    assert result(keyed.upsert(target, source, KEYS)) == sorted(
        [
            ("x", 1, 1, "new"),
            ("y", 1, 9, "stays"),
            (None, None, 1, "new"),
            ("z", None, 1, "added"),
        ],
        key=str,
    )


def test_older_sequence_loses_and_a_tie_goes_to_the_source(spark):
    target = frame(spark, [("x", 1, 5, "z"), ("y", 1, 5, "z")])
    source = frame(spark, [("x", 1, 4, "zz"), ("y", 1, 5, "a")])
    assert result(keyed.upsert(target, source, KEYS, ["seq"])) == [
        ("x", 1, 5, "z"),
        ("y", 1, 5, "a"),
    ]


def test_kept_columns_are_not_updated(spark):
    target = frame(spark, [("x", 1, 1, "kept")])
    source = frame(spark, [("x", 1, 2, "ignored"), ("y", 1, 2, "ignored")])
    assert result(keyed.upsert(target, source, KEYS, ["seq"], keep=["v"])) == [
        ("x", 1, 2, "kept"),
        ("y", 1, 2, None),
    ]


def test_new_source_columns_are_added(spark):
    target = frame(spark, [("x", 1)], "a string, n int")
    source = frame(spark, [("y", 2, 3)], "a string, n int, extra int")
    assert result(keyed.upsert(target, source, ["a"])) == [("x", 1, None), ("y", 2, 3)]


def test_one_key_may_be_null_or_composite(spark):
    rows = frame(spark, [(None, 1, 1, "p"), (None, 2, 2, "q"), ("x", 1, 1, "p")])
    assert result(keyed.latest_per_key(rows, ["a"], ["seq"])) == [
        ("x", 1, 1, "p"),
        (None, 2, 2, "q"),
    ]
    assert result(coded_rows(rows, ["seq"])) == [("x", 1, 1, "p")]


def test_map_side_combine_comes_before_the_shuffle(spark):
    rows = spark.range(10).selectExpr("id % 2 as a", "id as seq", "cast(id as string) as v")
    plan = keyed.latest_per_key(rows, ["a"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange") > plan.index("Aggregate")
