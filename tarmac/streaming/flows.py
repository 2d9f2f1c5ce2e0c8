"""The streaming queries. Each returns a query that stops once it has caught up.

Append sinks are Spark's file sink: every input file reaches the table once,
also after a restart. The keyed sink repeats a batch after a failure, which its
merge tolerates.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarmac.functions.times import as_instant
from tarmac.operators.flatten import flight_items
from tarmac.operators.quality import with_route
from tarmac.schemas import FACT_STORED
from tarmac.settings import FLIGHT_KEYS
from tarmac.sources.landing import ANY_AGE, bronze_pages, good_pages, stream_pages
from tarmac.sources.tables import KeyedTable, StreamTable


def append_table(
    stream: DataFrame, path: str, checkpoint: str, name: str, partition_by: list[str] = ()
) -> StreamingQuery:
    """Append a stream to a Parquet table."""
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .queryName(name)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()


def each_batch(
    stream: DataFrame, apply: Callable[[DataFrame], None], checkpoint: str, name: str
) -> StreamingQuery:
    """Hand every micro-batch to ``apply``, which must tolerate a repeat."""
    return (
        stream.writeStream.foreachBatch(lambda batch, _: apply(batch))
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_table(
    spark: SparkSession, path: str, schema: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A Parquet folder as a stream of the rows appended to it, however long ago."""
    reader = spark.readStream.schema(schema).option("maxFileAge", ANY_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


# A micro-batch takes about a second, however few files it has, and every tenth one writes down again all files seen.
MOST_BATCHES = 8


def files_per_batch(waiting: DataFrame, least: int, most_batches: int = MOST_BATCHES) -> int:
    """How many of the files that ``waiting`` reads a micro-batch takes: ``least``, or more where that would make many.

    So the time for a backlog follows its rows and not its files. The driver holds the names, as the stream does.
    """
    return max(least, math.ceil(len(waiting.inputFiles()) / most_batches))


def landing_to_bronze(
    spark: SparkSession,
    landing: str,
    table: StreamTable,
    checkpoint: str,
    name: str,
    max_files_per_trigger: int | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Landed pages into a bronze table by day of fetch, so that audits read only the days they ask for."""
    pages = stream_pages(spark, landing, max_files_per_trigger, archive)
    return table.append(bronze_pages(pages), checkpoint, name)


def parsed_rows(pages: DataFrame) -> DataFrame:
    """Good flight pages as rows with a ``route``: whether their key is complete.

    What was parsed and where it went is counted on the way, see ``route_counts``.
    """
    rows = flight_items(pages, ["fetched_at", "file_name"]).observe("parsed", F.count("*").alias("rows"))
    routed = with_route(rows.withColumn("silver_processed_at", F.current_timestamp()), FLIGHT_KEYS)
    return routed.observe(
        "routed",
        F.count_if(F.col("route") == "valid").alias("valid"),
        F.count_if(F.col("route") == "quarantine").alias("quarantine"),
    )


@dataclass(frozen=True)
class RouteCounts:
    """Rows that one micro-batch parsed, and how many of them went which way."""

    batch: int
    parsed: int
    valid: int
    quarantined: int


class RoutesDiffer(RuntimeError):
    """A batch has parsed rows that are neither valid nor in quarantine, or in both."""


def route_counts(query: StreamingQuery) -> list[RouteCounts]:
    """The counts of a query's recent micro-batches; fails if rows were lost or doubled between parsing and routing."""
    counts = []
    for progress in query.recentProgress:
        seen = {name: row.asDict() for name, row in progress.observedMetrics.items()}
        if "parsed" not in seen or "routed" not in seen:
            continue
        found = RouteCounts(
            progress.batchId, seen["parsed"]["rows"], seen["routed"]["valid"], seen["routed"]["quarantine"]
        )
        if found.valid + found.quarantined != found.parsed:
            raise RoutesDiffer(str(found))
        counts.append(found)
    return counts


def bronze_to_parsed(
    bronze: StreamTable, table: StreamTable, checkpoint: str, max_files_per_trigger: int | None = None
) -> StreamingQuery:
    """Flatten flight pages once, into a table split by route."""
    return table.append(parsed_rows(good_pages(bronze.stream(max_files_per_trigger))), checkpoint, "parsed_flights")


def quarantine(parsed: DataFrame) -> DataFrame:
    """Rows whose key is incomplete, with the missing columns; of the table, only their part is read.

    ``quarantined_at`` is the time at which the row was routed here.
    """
    missing = F.array_compact(F.array(*(F.when(F.col(key).isNull(), key) for key in FLIGHT_KEYS)))
    return (
        parsed.filter(F.col("route") == "quarantine")
        .drop("route")
        .withColumnRenamed("silver_processed_at", "quarantined_at")
        .withColumn("quarantine_reason", F.concat(F.lit("no "), F.array_join(missing, ", ")))
    )


def fact_table(spark: SparkSession, name: str, path: str) -> KeyedTable:
    """The flight fact: latest fetch wins, stored by UTC day of scheduled departure."""
    return KeyedTable(
        spark,
        name,
        path,
        FACT_STORED,
        FLIGHT_KEYS,
        ["fetched_at", "file_name"],  # the name decides between pages of the same second
        F.to_date("scheduled_departure_utc"),
    )


def parsed_to_fact(
    parsed: StreamTable,
    apply: Callable[[DataFrame], None],
    checkpoint: str,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Hand complete rows to ``apply``, normally a merge into the fact."""
    valid = parsed.stream(max_files_per_trigger).filter(F.col("route") == "valid").drop("route")
    return each_batch(valid, apply, checkpoint, "fact_flights")


def first_seen(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Only the first row of each key, for ever. The state grows with the keys.

    For true repeats only: in front of a keyed merge it would hide every later
    update of a row.
    """
    return stream.dropDuplicates(keys)


def first_seen_within(
    stream: DataFrame, keys: list[str], event_time: str, delay: str
) -> DataFrame:
    """The same among rows no more than ``delay`` apart by UTC time, so old state can go."""
    timed = stream.withColumn("__instant", as_instant(F.col(event_time)))
    unique = timed.withWatermark("__instant", delay).dropDuplicatesWithinWatermark(keys)
    return unique.drop("__instant")
