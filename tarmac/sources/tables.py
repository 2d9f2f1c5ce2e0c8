"""Tables of a lake in the session catalog: appended to by streams, or merged into by key.

Both are Parquet tables with a name and a location. Where the catalog does not outlive the session, a table is
entered again from its location when it is first named.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tarmac.operators import keyed
from tarmac.sources.landing import ANY_AGE

WHOLE = "all"
_WAITING = "waiting boolean"


def part_name(part: Column) -> Column:
    """A part's value as it is written in directory names."""
    return F.coalesce(part.cast("string"), F.lit("none"))


def _enter(spark: SparkSession, name: str, schema: str, path: str, partitions: list[str]) -> None:
    """Put a table into the catalog if it is not there, with the partitions its location has."""
    if spark.catalog.tableExists(name):
        return
    by = f"partitioned by ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"create database if not exists {name.rpartition('.')[0]}")
    spark.sql(f"create table if not exists {name} ({schema}) using parquet {by} location '{path}'")
    if partitions:
        # Appending nothing makes sure that there is a folder to look through.
        spark.createDataFrame([], schema).write.insertInto(name)
        spark.catalog.recoverPartitions(name)


@dataclass(frozen=True)
class StreamTable:
    """A table that a stream appends to. Readers follow the stream's own record of finished files."""

    spark: SparkSession
    name: str
    path: str
    schema: str
    partition_by: tuple[str, ...] = ()

    def read(self) -> DataFrame:
        """Its rows, by name. What a stream appended since the last look is included."""
        _enter(self.spark, self.name, self.schema, self.path, [])
        self.spark.catalog.refreshTable(self.name)
        return self.spark.read.table(self.name).select(*StructType.fromDDL(self.schema).names)

    def stream(self, max_files_per_trigger: int | None = None) -> DataFrame:
        """The rows appended to it, however long ago, as a stream by name."""
        _enter(self.spark, self.name, self.schema, self.path, [])
        reader = self.spark.readStream.option("maxFileAge", ANY_AGE)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.table(self.name).select(*StructType.fromDDL(self.schema).names)

    def append(self, stream: DataFrame, checkpoint: str, query: str) -> StreamingQuery:
        """Append a stream until it has caught up; every input file reaches the table once."""
        _enter(self.spark, self.name, self.schema, self.path, [])
        return (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .queryName(query)
            .option("path", self.path)
            .option("checkpointLocation", checkpoint)
            .partitionBy(*self.partition_by)
            .trigger(availableNow=True)
            .toTable(self.name)
        )


@dataclass(frozen=True)
class KeyedTable:
    """A table that is merged into by key.

    Plain Parquet has no MERGE, so a merge reads the parts it touches (for flights, calendar days), puts the
    newer rows in and lets Spark overwrite those partitions. Spark does not swap several
    partitions at once: a driver that dies while they are exchanged leaves some of them missing. So merged rows
    are written beside the table first, and the next merge finishes an exchange that was not ended. Repeating a merge is
    harmless: the outcome depends on the rows alone. One writer at a time.

    ``part`` names a text column derived from the keys; without it the table is one part. Part values become
    directory names, so they are plain words, and the driver holds a name per touched part, so a part is a
    coarse unit such as a day, never an entity.
    """

    spark: SparkSession
    name: str
    path: str
    schema: str
    keys: list[str]
    sequence: list[str] = field(default_factory=list)
    part: Column | None = None

    @property
    def columns(self) -> list[str]:
        return StructType.fromDDL(self.schema).names

    def exists(self) -> bool:
        """Whether anything was ever written."""
        return bool(self.parts()) if self.part is not None else not self.read().isEmpty()

    def parts(self) -> list[str]:
        """The parts the catalog knows, also those that have become empty."""
        self._enter()
        rows = self.spark.sql(f"show partitions {self.name}").collect()
        return [row[0].partition("=")[2] for row in rows]

    def read(self, parts: list[str] | None = None) -> DataFrame:
        """Current rows, of all parts or only of those named, which prunes the others."""
        self._enter()
        self.spark.catalog.refreshTable(self.name)
        rows = self.spark.read.table(self.name)
        if parts is not None and self.part is not None:
            rows = rows.filter(F.col("part").isin(list(parts)))
        return rows.select(*self.columns)

    def upsert(self, source: DataFrame, keep: list[str] = ()) -> list[str]:
        """Merge ``source`` in and return the parts it touched; only those are read and rewritten.

        On a table without parts this is the initial load, and nothing is written beside it.
        """
        self._finish()
        touched = [WHOLE]
        if self.part is not None:
            placed = source.withColumn("part", part_name(self.part))
            if not self.parts():
                self._overwrite(self._balanced(keyed.upsert(self._no_rows(), source, self.keys, self.sequence, keep)))
                return self.parts()
            # Written once by part, so that the batch is evaluated once and its parts are known.
            staged = f"{self.path}_staged/source"
            placed.write.mode("overwrite").partitionBy("part").parquet(staged)
            source = self.spark.read.schema(placed.schema).parquet(staged)
            touched = sorted(row[0] for row in source.select("part").distinct().collect())
            source = source.drop("part")
        if touched:
            merged = keyed.upsert(self.read(touched), source, self.keys, self.sequence, keep)
            writer = self._balanced(merged).write.mode("overwrite")
            (writer if self.part is None else writer.partitionBy("part")).parquet(f"{self.path}_staged/rows")
            self._mark(True)
            self._finish()
        return touched

    def replace(self, rows: DataFrame, parts: list[str] = (WHOLE,)) -> None:
        """Make ``rows``, which come from other tables, the whole content of ``parts``.

        A part without rows becomes empty; a row of another part fails the write. A run that dies in between
        has to replace the same parts again.
        """
        self._finish()
        if self.part is None:
            self._overwrite(rows)
            return
        known, parts = set(self.parts()), list(parts)
        outside = F.raise_error(F.concat(F.lit("row outside the replaced parts: "), F.col("part")))
        placed = self._balanced(rows).withColumn("part", F.when(F.col("part").isin(parts), F.col("part")).otherwise(outside))
        written = self._overwrite(placed, [F.count_if(F.col("part") == part).alias(part) for part in parts])
        for part in parts:
            if part in known and not written.get(part):
                # An overwrite by rows leaves a partition without rows alone; naming it empties it.
                self._no_rows().createOrReplaceTempView("tarmac_no_rows")
                self.spark.sql(
                    f"insert overwrite table {self.name} partition (part = '{part}') select * from tarmac_no_rows"
                )

    def _mark(self, waiting: bool) -> None:
        """Note whether complete rows wait beside the table."""
        mark = self.spark.createDataFrame([(waiting,)], _WAITING)
        mark.coalesce(1).write.mode("overwrite").parquet(f"{self.path}_staged/waiting")

    def _finish(self) -> None:
        """Exchange the partitions of which merged rows wait beside the table, if any."""
        self._enter()
        try:
            waiting = self.spark.read.schema(_WAITING).parquet(f"{self.path}_staged/waiting").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        if waiting and waiting[0]:
            columns = self.schema if self.part is None else f"{self.schema}, part string"
            self._overwrite(self.spark.read.schema(columns).parquet(f"{self.path}_staged/rows"))
            self._mark(False)

    def _overwrite(self, rows: DataFrame, counts: list[Column] = ()) -> dict[str, int]:
        """Spark's dynamic overwrite: only partitions that ``rows`` has are exchanged. Returns what was counted on the way."""
        columns = self.columns if self.part is None else [*self.columns, "part"]
        # The mode is a session setting; a session of its own keeps it from everyone else's writes.
        session = self.spark.newSession()
        session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        view = f"tarmac_rows_{uuid.uuid4().hex}"
        rows.select(*columns).createOrReplaceGlobalTempView(view)
        seen = Observation()
        try:
            incoming = session.read.table(f"global_temp.{view}").observe(seen, F.count("*").alias("all rows"), *counts)
            incoming.write.insertInto(self.name, overwrite=True)
            return seen.get
        finally:
            self.spark.catalog.dropGlobalTempView(view)
            self.spark.catalog.refreshTable(self.name)

    def _no_rows(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _balanced(self, rows: DataFrame) -> DataFrame:
        """Rows with their part. A part with too many rows is split over several writers; a small one stays in one file."""
        if self.part is None:
            return rows.select(*self.columns)
        return rows.select(*self.columns, part_name(self.part).alias("part")).hint("rebalance", "part")

    def _enter(self) -> None:
        by = [] if self.part is None else ["part"]
        schema = self.schema if self.part is None else f"{self.schema}, part string"
        _enter(self.spark, self.name, schema, self.path, by)
