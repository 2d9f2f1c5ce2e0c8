"""Column expressions over the text of one API response page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.settings import (
    ERROR_DESCRIPTION_DEFAULT,
    ERROR_ITEM,
    ERROR_ROOT,
    ERROR_TYPE_DEFAULT,
    META,
    PROXY_ERROR_KEYS,
    TOTAL_COUNT,
)


def items_at(page_text: Column, path: str, item_type: str) -> Column:
    """The array at ``path``, which must be a literal JSON path.

    ``from_json`` with an array schema takes a lone object as an array of one,
    but only at the top of its input, hence the cut-out first. One item of a
    wrong kind makes the whole array null; then items are parsed one by one.
    """
    body = F.get_json_object(page_text, path)
    together = F.from_json(body, f"array<{item_type}>")
    singly = F.transform(
        F.from_json(body, "array<string>"), lambda item: F.from_json(item, item_type)
    )
    return F.coalesce(together, singly)


def english_name(name_text: Column) -> Column:
    """The text under ``$`` of a name object; of several the English one, else the first."""
    names = F.from_json(name_text, "array<struct<`@LanguageCode`: string, `$`: string>>")
    english = F.filter(names, lambda name: name.getField("@LanguageCode") == "EN")
    return F.coalesce(F.get(english, 0).getField("$"), F.get(names, 0).getField("$"))


def _has_content(value: Column) -> Column:
    """True unless the variant is absent, null, false, zero or empty."""
    text = F.to_json(value)
    blank = text.isin("null", "false", '""', "[]", "{}") | text.try_cast("double").eqNullSafe(0)
    return F.coalesce(~blank, F.lit(False))


def _carries_proxy_message(page_text: Column) -> Column:
    """A proxy's message needs its type looked at, so these few small pages become variants."""
    members = F.try_variant_get(F.try_parse_json(page_text), "$", "map<string, variant>")
    messages = F.map_filter(members, lambda key, _: key.isin(*PROXY_ERROR_KEYS))
    return F.exists(F.map_values(messages), _has_content)


def page_status(page_text: Column, keys: Column) -> Column:
    """``ok``, ``api_error``, ``proxy_error`` or ``malformed``.

    ``keys`` are the page's top-level keys, null unless it is a JSON object. A
    proxy error is a response that claims success but carries neither data nor
    an API error, only a message under one of several spellings.
    """
    suspect = ~F.array_contains(keys, META) & F.arrays_overlap(
        keys, F.array(*(F.lit(key) for key in PROXY_ERROR_KEYS))
    )
    return (
        F.when(keys.isNull(), "malformed")
        .when(F.array_contains(keys, ERROR_ROOT), "api_error")
        .when(suspect & _carries_proxy_message(page_text), "proxy_error")
        .otherwise("ok")
    )


def first_error(page_text: Column) -> Column:
    """The first reported error as a struct of ``Type`` and ``Description``.

    Errors come as one object or a list, directly under the root key or one
    level further down.
    """
    root = F.get_json_object(page_text, f"$.{ERROR_ROOT}")
    errors = F.coalesce(F.get_json_object(root, f"$.{ERROR_ITEM}"), root)
    first = F.get(F.from_json(errors, "array<struct<Type: string, Description: string>>"), 0)
    return F.struct(
        F.coalesce(first.getField("Type"), F.lit(ERROR_TYPE_DEFAULT)).alias("Type"),
        F.coalesce(first.getField("Description"), F.lit(ERROR_DESCRIPTION_DEFAULT)).alias(
            "Description"
        ),
    )


def total_count(page_text: Column, keys: Column, resources: list[str]) -> Column:
    """The record count a page reports for its whole request, under whichever resource it has."""
    resource = F.get(F.array_intersect(keys, F.array(*(F.lit(name) for name in resources))), 0)
    path = F.concat(F.lit("$."), resource, F.lit(f".{META}.{TOTAL_COUNT}"))
    return F.call_function("get_json_object", page_text, path).try_cast("bigint")
