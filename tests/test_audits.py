from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from tarmac.operators import audits

PAGES = "g string, fetched_at timestamp_ntz, page_offset bigint, page_limit bigint, total_count bigint"
NOW = dt.datetime(2025, 3, 10)


def test_page_gaps_match_counting_records_one_by_one(spark):
    rng = random.Random(3)
    rows = []
    for g in "abcdefgh":
        total = rng.choice([0, 1, 49, 50, 51, 130, 200])
        for page in range(5):
            for _ in range(rng.randint(0, 2)):
                size = rng.choice([50, 50, 25, 12, 1])
                offset = page * 50 + rng.choice([0, 0, 12, 25])
                rows.append((g, NOW, offset, min(size, 50 - offset % 50), total))
    got = audits.page_gaps(spark.createDataFrame(rows, PAGES), ["g"], 50).collect()
    expected = set()
    for g, total in {(r[0], r[4]) for r in rows}:
        landed = {n for r in rows if r[0] == g for n in range(r[2], r[2] + r[3])}
        for start in range(0, total, 50):
            size = min(50, total - start)
            have = len(landed & set(range(start, start + 50)))
            if have < size:
                expected.add((g, start, size, have))
    assert {tuple(r) for r in got} == expected and len(got) == len(expected)


def test_piece_across_two_pages_counts_for_both(spark):
    rows = [("a", NOW, 25, 50, 100)]
    got = audits.page_gaps(spark.createDataFrame(rows, PAGES), ["g"], 50).collect()
    assert sorted(tuple(r) for r in got) == [("a", 0, 50, 25), ("a", 50, 50, 25)]


def test_total_of_the_newest_fetch_counts(spark):
    rows = [("a", NOW, 0, 50, 200), ("a", NOW + dt.timedelta(1), 0, 50, 60), ("a", NOW, 50, 50, None)]
    totals = audits.latest_totals(spark.createDataFrame(rows, PAGES), ["g"])
    assert [tuple(r) for r in totals.collect()] == [("a", 60)]


def test_very_long_request_is_listed_in_chunks(spark):
    totals = spark.createDataFrame([("a", 2_500_001)], "g string, total_count bigint")
    pages = audits.expected_pages(totals, ["g"], 1)
    row = pages.agg(F.count("*"), F.countDistinct("page_offset"), F.max("page_offset")).first()
    assert tuple(row) == (2_500_001, 2_500_001, 2_500_000)


def test_a_week_of_one_hub_is_84_requests(spark):
    hubs = spark.createDataFrame([("FRA",)], "hub string")
    spans = audits.lookback_spans(hubs, F.lit(dt.date(2025, 3, 10)), 7)
    slots = audits.expected_slots(spans)
    assert slots.count() == slots.distinct().count() == 84
    assert str(slots.agg(F.min("day")).first()[0]) == "2025-03-04"
    landed = slots.filter("not (slot = '04:00' and flight_type = 'arrivals')")
    assert audits.coverage_gaps(landed, spans).count() == 7


def test_page_duplicates(spark):
    items = [("a", 0, "k1"), ("a", 0, "k2"), ("a", 100, "k2"), ("a", 0, "k1"), ("b", 0, "k1")]
    totals = [("a", 100), ("b", 1), ("c", 7)]
    got = audits.page_duplicates(
        spark.createDataFrame(items, "g string, page_offset bigint, k string"),
        spark.createDataFrame(totals, "g string, total_count bigint"),
        ["g"],
        ["k"],
        100,
    )
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", 100, 4, 2, 1, 98, True),
        ("b", 1, 1, 1, 0, 0, False),
        ("c", 7, 0, 0, 0, 7, False),
    ]
