"""Create, update and delete events into bronze (log), silver (latest state) and gold (per group).

Each micro-batch writes new folders and never touches the ones readers use:

* bronze/batch_id=N is overwritten when batch N is replayed, so nothing is logged twice;
* silver holds the latest event of every key, deletions included, in buckets of the key's hash. Batch N
  writes silver/version=N with just the buckets it touches, made from their versions before and the
  batch; the newest version of each bucket is the state. A batch costs the keys of the buckets it
  touches, not the length of the history;
* gold/version=N holds, for those buckets alone, what each adds to every group: counts, sums and the latest time. The rollup is the
  sum over the newest of every bucket, so a batch reads and writes nothing of the buckets it does not touch, neither state nor gold.

A version counts once its _SUCCESS marker is there, so a reader always finds whole buckets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    DoubleType, IntegerType, StringType, StructField, StructType, TimestampType,
)

from placerank import fixed
from placerank.operators.dedupe import latest_per
from placerank.operators.rollup import state_by_group
from placerank.sources.files import children, delete, exists

EVENT_SCHEMA = StructType(
    [
        StructField(name, kind)
        for name, kind in [
            ("event_id", StringType()), ("event_type", StringType()), ("club_id", StringType()),
            ("name", StringType()), ("city", StringType()), ("department", StringType()),
            ("latitude", DoubleType()), ("longitude", DoubleType()), ("courts", IntegerType()),
            ("source", StringType()), ("event_time", StringType()),
        ]
    ]
)
STATE_SCHEMA = StructType(
    [StructField("raw_json", StringType()), StructField("message_time", TimestampType())]
    + EVENT_SCHEMA.fields
    + [StructField("event_timestamp", TimestampType()), StructField("ingested_at", TimestampType())]
)


GOLD_SCHEMA = "department string, nb_active_clubs long, nb_total_courts long, last_event_time timestamp"


def parse_events(raw: DataFrame, schema: StructType = EVENT_SCHEMA) -> DataFrame:
    """Messages (value, timestamp) to event columns; text that does not parse gives null fields."""
    text = raw.select(F.col("value").cast("string").alias("raw_json"), F.col("timestamp").alias("message_time"))
    return (
        text.withColumn("event", F.from_json("raw_json", schema))
        .select("raw_json", "message_time", "event.*")
        .withColumn("event_timestamp", F.try_to_timestamp("event_time"))
        .withColumn("ingested_at", F.current_timestamp())
    )


def _valid(types):
    known = F.col("event_id").isNotNull() & F.col("club_id").isNotNull()
    return known & F.coalesce(F.col("event_type").isin(*types), F.lit(False))


def valid_events(events: DataFrame, types=fixed.EVENT_TYPES) -> DataFrame:
    return events.filter(_valid(types))


def split_valid(events: DataFrame, types=fixed.EVENT_TYPES) -> tuple[DataFrame, DataFrame]:
    """(usable events, rejected messages)."""
    return events.filter(_valid(types)), events.filter(~_valid(types))


def latest_state(events: DataFrame, key: str = "club_id") -> DataFrame:
    """The latest event per key with deletions; event time first, then arrival, then id."""
    return latest_per(events, key, "event_timestamp", "ingested_at", "event_id")


def active(state: DataFrame, delete_type: str = fixed.DELETE_EVENT) -> DataFrame:
    return state.filter(F.col("event_type") != delete_type)


def gold_by(current: DataFrame, key: str = "department") -> DataFrame:
    return state_by_group(current, key, "club_id", "courts", "event_timestamp").withColumnsRenamed(
        {"n_active": "nb_active_clubs", "n_total": "nb_total_courts", "last_time": "last_event_time"}
    )


def gold_parts(state: DataFrame, key: str = "department", delete_type: str = fixed.DELETE_EVENT) -> DataFrame:
    """What each bucket of the state adds to every group. A key is in one bucket, so counts of keys may be added up.

    Groups whose keys are all deleted stay with 0, so that a bucket has a row as long as it has a key.
    """
    here = F.col("event_type") != delete_type
    return state.groupBy("bucket", key).agg(
        F.count_if(here).alias("nb_active_clubs"),
        F.sum(F.when(here, F.coalesce(F.col("courts"), F.lit(0))).otherwise(0)).alias("nb_total_courts"),
        F.max(F.when(here, F.col("event_timestamp"))).alias("last_event_time"),
    )


def merged_gold(parts: DataFrame, key: str = "department") -> DataFrame:
    """The rollup from the parts of all buckets."""
    return parts.groupBy(key).agg(
        F.sum("nb_active_clubs").alias("nb_active_clubs"), F.sum("nb_total_courts").alias("nb_total_courts"),
        F.max("last_event_time").alias("last_event_time"),
    ).filter(F.col("nb_active_clubs") > 0)


@dataclass(frozen=True)
class EventTables:
    """The folders of one stream. ``buckets`` must stay the same over the life of the tables."""

    root: str
    buckets: int = 64

    def bucket(self, key: str = "club_id") -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def summary(self) -> str:
        return f"{self.root}/summary"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"

    def versions(self, spark: SparkSession, table: str) -> list[int]:
        """Complete versions, oldest first."""
        return sorted(
            int(name.split("=")[1])
            for name in children(spark, table)
            if name.startswith("version=") and exists(spark, f"{table}/{name}/_SUCCESS")
        )

    def state_parts(self, spark: SparkSession, before: int | None = None, table: str | None = None) -> dict[int, int]:
        """Newest complete version of each bucket, of the state or another table kept in buckets."""
        table, parts = table or self.silver, {}
        for version in self.versions(spark, table):
            if before is None or version < before:
                for name in children(spark, f"{table}/version={version}"):
                    if name.startswith("bucket="):
                        parts[int(name.split("=")[1])] = version
        return parts

    def read_state(self, spark: SparkSession, before: int | None = None, only: set[int] | None = None) -> DataFrame:
        """Latest event per key, deletions included; of some buckets, and before a batch, if wanted."""
        paths = [
            f"{self.silver}/version={v}/bucket={b}"
            for b, v in self.state_parts(spark, before).items() if only is None or b in only
        ]
        if not paths:
            return spark.createDataFrame([], STATE_SCHEMA)
        return spark.read.schema(STATE_SCHEMA).parquet(*paths)

    def drop_superseded(self, spark: SparkSession) -> None:
        """Delete what neither the newest state nor the one before it, which readers may hold, needs."""
        for table in (self.silver, self.gold):
            known = self.versions(spark, table)
            needed = set(self.state_parts(spark, table=table).items())
            needed |= set(self.state_parts(spark, known[-1], table).items()) if known else set()
            for version in known:
                names = [n for n in children(spark, f"{table}/version={version}") if n.startswith("bucket=")]
                gone = [n for n in names if (int(n.split("=")[1]), version) not in needed]
                if names and len(gone) == len(names):
                    delete(spark, f"{table}/version={version}")
                else:
                    for name in gone:
                        delete(spark, f"{table}/version={version}/{name}")

    def read_silver(self, spark: SparkSession) -> DataFrame:
        return active(self.read_state(spark))

    def read_bronze(self, spark: SparkSession) -> DataFrame:
        if not children(spark, self.bronze):
            return spark.createDataFrame([], STATE_SCHEMA)
        return spark.read.schema(STATE_SCHEMA).parquet(self.bronze)

    def read_gold(self, spark: SparkSession) -> DataFrame:
        """The rollup after the last batch, from one small file per bucket."""
        paths = [f"{self.gold}/version={v}/bucket={b}" for b, v in self.state_parts(spark, table=self.gold).items()]
        return merged_gold(spark.read.schema(GOLD_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], GOLD_SCHEMA))


def append_bronze(batch: DataFrame, tables: EventTables, batch_id: int) -> int:
    """Log the events of a batch; their number is observed while they are written."""
    seen = Observation("logged")
    batch.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{tables.bronze}/batch_id={batch_id}")
    return seen.get["n"]


def process_batch(batch: DataFrame, batch_id: int, tables: EventTables, types=fixed.EVENT_TYPES) -> None:
    """One micro-batch: log it, move the touched state and gold one version on, note the counts."""
    spark = batch.sparkSession
    batch.persist()
    try:
        if batch.isEmpty():
            return
        good, bad = split_valid(batch, types)
        bad.write.mode("overwrite").parquet(f"{tables.rejects}/batch_id={batch_id}")
        events = append_bronze(good, tables, batch_id)
    finally:
        batch.unpersist()
    # read back: the source is parsed once, and silver sees exactly what bronze holds
    logged = spark.read.schema(STATE_SCHEMA).parquet(f"{tables.bronze}/batch_id={batch_id}")
    # at most one row per bucket comes to the driver
    touched = {r[0] for r in logged.select(tables.bucket().alias("bucket")).distinct().collect()}
    if touched:
        before = tables.read_state(spark, before=batch_id, only=touched)
        moved = latest_state(before.unionByName(logged)).withColumn("bucket", tables.bucket())
        silver, gold = (f"{t}/version={batch_id}" for t in (tables.silver, tables.gold))
        moved.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(silver)
        written = spark.read.schema(StructType([*STATE_SCHEMA.fields, StructField("bucket", IntegerType())])).parquet(silver)
        gold_parts(written).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(gold)
    note = batch_summary(events, tables.read_gold(spark), batch_id)
    note.coalesce(1).write.mode("overwrite").parquet(f"{tables.summary}/batch_id={batch_id}")
    tables.drop_superseded(spark)


def batch_summary(events: int, gold: DataFrame, batch_id: int) -> DataFrame:
    """Events in the batch, active keys and groups after it; from the rollup, not the state. An empty and no group are one."""
    return gold.agg(
        F.coalesce(F.sum("nb_active_clubs"), F.lit(0)).alias("active_clubs"),
        F.count_distinct(F.coalesce("department", F.lit(""))).alias("departments"),
    ).select(F.lit(batch_id).alias("id"), F.lit(events).cast("long").alias("events_batch"), "active_clubs", "departments")


def start_stream(
    raw: DataFrame, tables: EventTables, *, once: bool = False, name: str = "club_events",
    trigger_seconds: int | None = None, types=fixed.EVENT_TYPES,
) -> StreamingQuery:
    """Start the query; ``once`` works off what is there and stops."""
    writer = (
        parse_events(raw).writeStream
        .foreachBatch(lambda batch, batch_id: process_batch(batch, batch_id, tables, types))
        .option("checkpointLocation", tables.checkpoint)
        .queryName(name)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    elif trigger_seconds:
        writer = writer.trigger(processingTime=f"{trigger_seconds} seconds")
    return writer.start()


def run_stream(raw: DataFrame, tables: EventTables, *, once: bool = False, duration: int | None = None, **kw) -> None:
    """Run to the end (``once``), for ``duration`` seconds, or until stopped."""
    query = start_stream(raw, tables, once=once, **kw)
    if duration is not None:
        query.awaitTermination(duration)
        query.stop()
    else:
        query.awaitTermination()
