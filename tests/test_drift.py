"""What items look like beside the declared schema."""

from __future__ import annotations

import json

from pages import flight

from tarmac.operators import drift
from tarmac.schemas import FLIGHT_ITEM


def items(spark, *values):
    return spark.createDataFrame([(v if v is None or isinstance(v, str) else json.dumps(v),) for v in values], "item_text string")


def found(frame):
    return sorted((r.path, r.field, r.kind, r.declared_kind, r["items"]) for r in frame.collect())


def test_items_that_fit_have_no_drift(spark):
    plain = {k: v for k, v in flight(actual="2025-03-10T08:00Z").items() if k != "MarketingCarrier"}
    assert found(drift.schema_drift(items(spark, plain, plain), FLIGHT_ITEM)) == []


def test_new_fields_and_other_kinds(spark):
    changed = flight(Departure__Terminal={"Name": 1, "Gate": None}, Arrival="soon", Equipment__Seats=[1])
    rows = found(drift.schema_drift(items(spark, flight(), changed), FLIGHT_ITEM))
    assert rows == [
        ("$", "Arrival", "string", "object", 1),
        ("$", "MarketingCarrier", "object", None, 2),
        ("$.Departure.Terminal", "Name", "number", "string", 1),
        ("$.Equipment", "Seats", "array", None, 1),
    ]


def test_odd_items(spark):
    odd = items(spark, None, "", "no json", "[1]", "{}", {"Departure": {"X": None, "Y": True, "Z": 1.5}})
    assert found(drift.schema_drift(odd, FLIGHT_ITEM)) == [
        ("$.Departure", "X", "null", None, 1),
        ("$.Departure", "Y", "boolean", None, 1),
        ("$.Departure", "Z", "number", None, 1),
    ]
    assert found(drift.schema_drift(items(spark), FLIGHT_ITEM)) == []


def test_merged_type_holds_every_item(spark):
    merged = drift.merged_type(items(spark, {"a": 1, "b": "x"}, {"a": 2.5, "c": [1]})).first()[0]
    assert merged.startswith("OBJECT<") and all(name in merged for name in ("a:", "b:", "c:"))
