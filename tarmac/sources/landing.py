"""Landed JSON pages, one document per file, as bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions.lineage import lineage_columns
from tarmac.functions.pages import first_error, page_status, total_count
from tarmac.functions.times import as_utc
from tarmac.settings import FLIGHT_RESOURCE, REFERENCE_RESOURCES

RESOURCES = [FLIGHT_RESOURCE, *REFERENCE_RESOURCES.values()]


# Files count whatever their age. By default a stream would pass over files that are a week
# older than the newest one it has seen.
ANY_AGE = "36500d"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page files as rows of ``page_text``, ``file_name`` and ``landed_at``."""
    return _named(spark.read.text(path, wholetext=True))


def stream_pages(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """The same as a stream that takes each file once, however old it is.

    The driver lists the folder and remembers every file in it. With ``archive``, a folder
    outside ``path``, files that were taken are moved there, so both stay small; or let ``path``
    be a pattern over dated folders of which old ones are taken out of it.
    """
    reader = spark.readStream.option("maxFileAge", ANY_AGE)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _named(reader.text(path, wholetext=True))


def _named(files: DataFrame) -> DataFrame:
    return files.select(
        F.col("value").alias("page_text"),
        F.col("_metadata.file_name").alias("file_name"),
        as_utc(F.col("_metadata.file_modification_time")).alias("landed_at"),
    )


def classify(pages: DataFrame) -> DataFrame:
    """Say of each page whether it is data, and keep its text either way.

    The keys are listed in a generator because Spark copies a projected
    expression into every filter above it, and a filter on the status names
    them many times.
    """
    text, keys = F.col("page_text"), F.col("page_keys")
    # json_object_keys stops at the closing brace. As the one element of an array the text is read
    # to its end, and anything behind the brace makes the array invalid or longer.
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    whole = F.when(alone, F.json_object_keys(text))
    once = F.inline(F.array(F.struct(whole.alias("page_keys"))))
    judged = pages.select("*", once).withColumns(
        {"page_status": page_status(text, keys), "total_count": total_count(text, keys, RESOURCES)}
    )
    error = F.when(F.col("page_status") == "api_error", first_error(text))
    return (
        judged.withColumn("error", error)
        .withColumns({"error_type": F.col("error.Type"), "error_description": F.col("error.Description")})
        .drop("page_keys", "error")
    )


def bronze_pages(pages: DataFrame) -> DataFrame:
    """Pages with status, lineage and ingest time: the bronze table's rows.

    A file whose name does not say when it was fetched counts as fetched when it landed, so
    that what it brings can still replace older rows.
    """
    lineage = lineage_columns(F.col("file_name"))
    if "landed_at" in pages.columns:
        lineage["fetched_at"] = F.coalesce(lineage["fetched_at"], F.col("landed_at"))
    return classify(pages).select(
        "page_text",
        "page_status",
        "error_type",
        "error_description",
        "file_name",
        *(value.alias(name) for name, value in lineage.items()),
        "total_count",
        F.current_timestamp().alias("bronze_ingested_at"),
        F.to_date(lineage["fetched_at"]).alias("fetch_day"),
    )


def good_pages(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("page_status") == "ok")


def rejected_pages(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("page_status") != "ok")


def discover_schema(spark: SparkSession, sample: str) -> str:
    """The DDL Spark would infer for one page; for looking at new pages, not for pipelines."""
    return spark.range(1).select(F.schema_of_json(F.lit(sample))).first()[0]
