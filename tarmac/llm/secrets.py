"""Secret scan: fixed patterns, and windows of high entropy in random-looking strings.

Everything is a column expression, so the scan is one pass without a shuffle. Positions are code
points: a text is its matches and the gaps between them, so running sums of their lengths say
where each match stands.

The entropy of a window of ``WINDOW`` characters with counts c is ``log2(W) - sum(c log2 c) / W``.
Moving the window by one character changes two counts, so the sum is kept up, never computed anew.

Null text counts as empty; both give no spans. Repeated rows give repeated results, no other
column is read, and long texts and long strings are scanned whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import documents_of

# The base patterns and the length each match needs.
ASSIGN = (
    r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_LENGTH = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
BASE_KINDS = ["assign", "access", "hex"]

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"

#: Strings that look random but are known to be harmless.
ALLOWED = [
    r"(?i)example|sample|dummy|placeholder|changeme",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"(?i)^(?:0123456789|123456789|abcdefghij)",
]


@dataclass(frozen=True)
class CharClass:
    """A kind of string: what it consists of and the bits per character a secret's window has."""

    kind: str
    pattern: str
    bits: float


#: The first class that fits a string counts. Each asks for digits, which prose has not.
CLASSES = [
    CharClass("entropy_hex", r"^(?=.*[0-9])(?:[0-9a-f]+|[0-9A-F]+)$", 3.0),
    CharClass("entropy_alnum", r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9]+$", 3.6),
    CharClass("entropy_base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z]).+$", 3.8),
]

_BLOCK = 256


def running_sums(lengths: Column) -> Column:
    """Sum of all earlier elements, for each element; by blocks, so that many elements stay cheap."""

    def sums(values: Column, start: Column) -> Column:
        seed = F.struct(start.alias("at"), F.array().cast("array<long>").alias("all"))
        return F.aggregate(
            values,
            seed,
            lambda acc, v: F.struct(
                (acc["at"] + v).alias("at"), F.array_append(acc["all"], acc["at"]).alias("all")
            ),
            lambda acc: acc["all"],
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(lengths) / _BLOCK).cast("int")),
        lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK)),
    )
    totals = F.transform(
        blocks, lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, v: a + v)
    )
    return F.flatten(F.zip_with(blocks, sums(totals, F.lit(0).cast("long")), sums))


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) of the leftmost non-overlapping matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    lengths = F.zip_with(
        gaps, found, lambda g, m: (F.char_length(g) + F.char_length(m)).cast("long")
    )
    ends = F.zip_with(running_sums(lengths), lengths, lambda start, n: start + n)
    spans = F.zip_with(
        ends,
        found,
        lambda end, m: F.struct((end - F.char_length(m)).alias("start"), end.alias("end"), m.alias("match")),
    )
    return F.when(text.rlike(pattern), spans).otherwise(
        F.array().cast("array<struct<start:bigint,end:bigint,match:string>>")
    )


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each base kind; an assignment whose value is too short is dropped."""
    assign = F.filter(
        matches(text, ASSIGN),
        lambda s: F.char_length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_LENGTH,
    )
    return {"assign": assign, "access": matches(text, ACCESS), "hex": matches(text, HEX)}


def high_windows(match: Column, bits: Column, window: int = WINDOW) -> Column:
    """Merged (start, end) of the windows of an ASCII string with at least so many bits a character."""
    term = F.array(*[F.lit(k * math.log2(k) if k else 0.0) for k in range(window + 1)])
    codes = F.transform(F.split(match, ""), F.ascii)
    spans = F.array().cast("array<struct<start:int,end:int>>")
    seed = F.struct(
        F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0.0).alias("total"), spans.alias("spans")
    )

    def step(codes: Column):
        def move(acc: Column, i: Column) -> Column:
            new = F.element_at(codes, i)
            old = F.when(i > window, F.get(codes, i - window - 1)).otherwise(F.lit(-1))
            at = lambda code: F.get(acc["counts"], code)
            grow = F.get(term, at(new) + 1) - F.get(term, at(new))
            shrink = F.coalesce(F.get(term, at(old)) - F.get(term, at(old) - 1), F.lit(0.0))
            total = acc["total"] + F.when(new == old, 0.0).otherwise(grow - shrink)
            counts = F.transform(
                acc["counts"], lambda n, k: n + (k == new).cast("int") - (k == old).cast("int")
            )
            last = F.element_at(acc["spans"], -1)
            here = F.struct((i - window).alias("start"), i.alias("end"))
            joined = F.struct(last["start"].alias("start"), i.alias("end"))
            hit = (i >= window) & (F.lit(math.log2(window)) - total / window >= bits)
            all_but_last = F.slice(acc["spans"], F.lit(1), F.size(acc["spans"]) - 1)
            spans = (
                F.when(~hit, acc["spans"])
                .when(F.size(acc["spans"]) == 0, F.array(here))
                .when(last["end"] >= i - window, F.array_append(all_but_last, joined))
                .otherwise(F.array_append(acc["spans"], here))
            )
            return F.struct(counts.alias("counts"), total.alias("total"), spans.alias("spans"))

        return move

    merged = F.transform(
        F.array(codes),
        lambda c: F.aggregate(
            F.sequence(F.lit(1), F.size(c)), seed, step(c), lambda acc: acc["spans"]
        ),
    )
    return F.get(merged, 0)


def entropy_spans(text: Column, classes=CLASSES, allowed=ALLOWED, window: int = WINDOW) -> Column:
    """Array of (start, end, kind) of high-entropy parts of strings that no allow-list entry fits."""
    fits = lambda s, pattern: s["match"].rlike(pattern)
    harmless = lambda s: F.array_contains(F.array(*[fits(s, p) for p in allowed]), True)
    strings = F.filter(
        matches(text, CANDIDATE),
        lambda s: ~harmless(s)
        & F.array_contains(F.array(*[fits(s, c.pattern) for c in classes]), True),
    )

    def spans(s: Column) -> Column:
        kind, bits = F.lit(classes[-1].kind), F.lit(classes[-1].bits)
        for c in reversed(classes[:-1]):
            kind = F.when(fits(s, c.pattern), c.kind).otherwise(kind)
            bits = F.when(fits(s, c.pattern), c.bits).otherwise(bits)
        return F.transform(
            high_windows(s["match"], bits, window),
            lambda w: F.struct(
                (s["start"] + w["start"]).alias("start"),
                (s["start"] + w["end"]).alias("end"),
                kind.alias("kind"),
            ),
        )

    return F.flatten(F.transform(strings, spans))


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the base spans of each kind and the high-entropy spans, each with start and end."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = base_spans(text)
    return documents_of(documents, id_col, text_col).select(
        "doc_id",
        *[base[kind].alias(kind) for kind in BASE_KINDS],
        entropy_spans(text).alias("entropy"),
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, a digest of the base spans and all spans as text."""

    def listed(column: str, kind, rank: int) -> Column:
        return F.transform(
            column,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(rank).alias("rank"),
                (s["kind"] if kind is None else F.lit(kind)).alias("kind"),
                s["end"].alias("end"),
            ),
        )

    def joined(spans: Column) -> Column:
        one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
        return F.concat_ws(",", F.transform(F.array_sort(spans), one))

    base = F.concat(*[listed(kind, kind, rank) for rank, kind in enumerate(BASE_KINDS)])
    every = F.concat(base, listed("entropy", None, len(BASE_KINDS)))
    return found.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(every).alias("spans"),
    )
