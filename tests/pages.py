"""Hand-made API pages."""

from __future__ import annotations

import json
import os


def flight(number="400", scheduled="2025-03-10T08:00Z", actual=None, status="Scheduled", **changes):
    item = {
        "OperatingCarrier": {"AirlineID": "X1", "FlightNumber": number},
        "Departure": {
            "AirportCode": "FRA",
            "ScheduledTimeUTC": {"DateTime": scheduled},
            "Terminal": {"Name": "1", "Gate": "B22"},
            "TimeStatus": {"Code": "OT", "Definition": "Flight On Time"},
        },
        "Arrival": {
            "AirportCode": "JFK",
            "ScheduledTimeUTC": {"DateTime": "2025-03-10T16:30Z"},
        },
        "MarketingCarrier": {"AirlineID": "UA", "FlightNumber": "8840"},
        "Equipment": {"AircraftCode": "74H", "AircraftRegistration": "DABYA"},
        "FlightStatus": {"Code": "NA", "Definition": status},
    }
    if actual:
        item["Departure"]["ActualTimeUTC"] = {"DateTime": actual}
    for path, value in changes.items():
        node = item
        *parents, last = path.split("__")
        for name in parents:
            node = node.setdefault(name, {})
        if value is None:
            node.pop(last, None)
        else:
            node[last] = value
    return item


def flight_page(items, total=None):
    count = len(items) if isinstance(items, list) else 1
    return {
        "FlightStatusResource": {
            "Flights": {"Flight": items},
            "Meta": {"TotalCount": count if total is None else total},
        }
    }


def reference_page(resource, collection, item_name, items):
    count = len(items) if isinstance(items, list) else 1
    return {resource: {collection: {item_name: items}, "Meta": {"TotalCount": count}}}


def named(code_field, code, name, **others):
    names = {"Name": {"@LanguageCode": "EN", "$": name}}
    return {code_field: code, "Names": names, **others}


def land(folder, page, fetched, prefix="FRA_departures_2025-03-10T0400", offset=0, limit=50):
    """Write one page file the way the fetcher does: indented, one object per file."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{fetched}_{prefix}_off{offset}_lim{limit}.json")
    with open(path, "w", encoding="utf-8") as out:
        json.dump(page, out, ensure_ascii=False, indent=4)
    return path
