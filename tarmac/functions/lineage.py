"""What a landed file's name says about the request that produced it.

Name: ``<yyyyMMddHHmmss>_<prefix>_off<offset>_lim<limit>.json`` with prefix
``<hub>_<arrivals|departures>_<yyyy-MM-dd>T<HHmm>`` or ``ref_<endpoint>``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FILE_PATTERN = r"^(\d{14})_(.+)_off(\d+)_lim(\d+)\.json$"
SLOT_PATTERN = r"^(.+)_(arrivals|departures)_(\d{4}-\d{2}-\d{2})T(\d{2})(\d{2})$"
REFERENCE_PATTERN = r"^ref_(.+)$"


def _part(text: Column, pattern: str, group: int) -> Column:
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def _fetch_clock(digits: Column) -> Column:
    pieces = F.regexp_replace(
        digits, r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1-$2-$3T$4:$5:$6"
    )
    return pieces.try_cast("timestamp_ntz")


def lineage_columns(file_name: Column) -> dict[str, Column]:
    """Columns keyed by name; null wherever the name does not follow the scheme."""
    prefix = _part(file_name, FILE_PATTERN, 2)
    clock = F.concat_ws(
        ":",
        F.concat_ws("T", _part(prefix, SLOT_PATTERN, 3), _part(prefix, SLOT_PATTERN, 4)),
        _part(prefix, SLOT_PATTERN, 5),
        F.lit("00"),
    )
    return {
        "fetched_at": _fetch_clock(_part(file_name, FILE_PATTERN, 1)),
        "endpoint": _part(prefix, REFERENCE_PATTERN, 1),
        "hub": _part(prefix, SLOT_PATTERN, 1),
        "flight_type": _part(prefix, SLOT_PATTERN, 2),
        "slot_start": clock.try_cast("timestamp_ntz"),
        "page_offset": _part(file_name, FILE_PATTERN, 3).try_cast("bigint"),
        "page_limit": _part(file_name, FILE_PATTERN, 4).try_cast("bigint"),
    }
