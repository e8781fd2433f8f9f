"""The event stream: order, split and replay of the messages do not change the state."""

import itertools
import json

import pytest
from pyspark.sql import DataFrameReader, functions as F

from placerank.session import new_path
from placerank.sources.readers import read_events
from placerank.streaming import events as ev


def message(i, kind, club, time, courts=None, department="75"):
    return json.dumps(
        {"event_id": f"e{i}", "event_type": kind, "club_id": club, "department": department, "courts": courts, "event_time": time}
    )


MESSAGES = [
    message(1, "club_created", "a", "2024-01-01T10:00:00", 2),
    message(2, "club_updated", "a", "2024-01-02T10:00:00", 4),
    message(3, "club_created", "b", "2024-01-01T09:00:00", None),
    message(4, "club_deleted", "b", "2024-01-03T09:00:00"),
    message(5, "club_created", "c", "2024-01-01T00:00:00", 1, "13"),
    message(6, "club_deleted", "c", "2024-01-02T00:00:00", None, "13"),
    message(7, "club_created", "c", "2024-01-03T00:00:00", 9, "13"),
    message(8, "club_updated", "a", "not a time", 50),
    message(9, "club_viewed", "a", "2024-02-01T00:00:00"),
    message(10, "club_created", None, "2024-01-01T00:00:00"),
    "{garbage",
    '{"event_id": "e11", "event_type": "club_created", "club_id": "d", "courts": "many", "event_time": "2024-01-01T00:00:00"}',
]
SILVER = {("a", "e2", 4), ("c", "e7", 9), ("d", "e11", None)}


def offer(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def consume(spark, path, tables, **options):
    ev.run_stream(read_events(spark, "text", path, **options), tables, once=True)


def silver(spark, tables):
    return {(r["club_id"], r["event_id"], r["courts"]) for r in tables.read_silver(spark).collect()}


@pytest.mark.parametrize("split", [[12], [3, 3, 3, 3], [5, 7]])
@pytest.mark.parametrize("backwards", [False, True])
def test_state_does_not_depend_on_batches(spark, split, backwards):
    lines = MESSAGES[::-1] if backwards else MESSAGES
    path, tables = new_path(spark, "in"), ev.EventTables(new_path(spark, "t"), buckets=3)
    it = iter(lines)
    for n in split:
        offer(spark, path, itertools.islice(it, n))
        consume(spark, path, tables)
    assert silver(spark, tables) == SILVER
    assert tables.read_bronze(spark).count() == 9
    gold = {r["department"]: (r["nb_active_clubs"], r["nb_total_courts"]) for r in tables.read_gold(spark).collect()}
    assert gold == {"75": (1, 4), "13": (1, 9), None: (1, 0)}


def test_replayed_batch_changes_nothing(spark):
    path, tables = new_path(spark, "in"), ev.EventTables(new_path(spark, "t"), buckets=3)
    offer(spark, path, MESSAGES)
    consume(spark, path, tables)
    raw = spark.createDataFrame([(m,) for m in MESSAGES], "value string").withColumn("timestamp", F.current_timestamp())
    ev.process_batch(ev.parse_events(raw), 0, tables)
    assert silver(spark, tables) == SILVER
    assert tables.read_bronze(spark).count() == 9
    assert spark.read.schema(ev.STATE_SCHEMA).parquet(tables.rejects).count() == 3


def test_empty_batch_and_empty_tables(spark):
    tables = ev.EventTables(new_path(spark, "t"), buckets=3)
    assert tables.read_silver(spark).count() == 0 and tables.read_bronze(spark).count() == 0
    raw = spark.createDataFrame([], "value string, timestamp timestamp")
    ev.process_batch(ev.parse_events(raw), 0, tables)
    assert tables.versions(spark, tables.silver) == []


def test_a_version_without_marker_is_not_read(spark):
    path, tables = new_path(spark, "in"), ev.EventTables(new_path(spark, "t"), buckets=3)
    offer(spark, path, MESSAGES)
    consume(spark, path, tables)
    half = f"{tables.silver}/version=7"
    spark.range(3).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    assert tables.versions(spark, tables.silver) == [0] and 7 not in tables.state_parts(spark).values()
    assert silver(spark, tables) == SILVER


def test_bounded_run_stops(spark):
    path, tables = new_path(spark, "in"), ev.EventTables(new_path(spark, "t"), buckets=3)
    offer(spark, path, MESSAGES)
    ev.run_stream(read_events(spark, "text", path), tables, duration=15, name="bounded")
    assert not [q for q in spark.streams.active if q.name == "bounded"]
    assert silver(spark, tables) == SILVER


def test_a_batch_rewrites_only_the_buckets_it_touches(spark):
    path, tables = new_path(spark, "in"), ev.EventTables(new_path(spark, "t"), buckets=16)
    lines = [message(i, "club_created", f"k{i}", "2024-01-01T00:00:00", 1) for i in range(40)]
    offer(spark, path, lines)
    consume(spark, path, tables)
    first = tables.state_parts(spark)
    for n, time in enumerate(("2024-01-02T00:00:00", "2024-01-03T00:00:00", "2024-01-04T00:00:00")):
        offer(spark, path, [message(100 + n, "club_updated", "k7", time, 5 + n)])
        consume(spark, path, tables)
    last = tables.state_parts(spark)
    assert set(first.values()) == {0}
    assert sorted(last.values()).count(0) == len(first) - 1 and max(last.values()) == 3
    state = {r["club_id"]: r["courts"] for r in tables.read_silver(spark).collect()}
    assert len(state) == 40 and state["k7"] == 7
    # version 1 held only the bucket that versions 2 and 3 replaced
    assert tables.versions(spark, tables.silver) == [0, 2, 3]


def test_gold_of_an_untouched_bucket_is_neither_read_nor_written(spark):
    path, tables = new_path(spark, "in"), ev.EventTables(new_path(spark, "t"), buckets=16)
    offer(spark, path, [message(i, "club_created", f"k{i}", "2024-01-01T00:00:00", 1, str(i % 3)) for i in range(40)])
    consume(spark, path, tables)
    first = tables.state_parts(spark, table=tables.gold)
    home = spark.createDataFrame([("k7",)], "club_id string").select(tables.bucket()).first()[0]
    opened = []
    kept = DataFrameReader.parquet
    DataFrameReader.parquet = lambda self, *paths, **kw: (opened.extend(paths), kept(self, *paths, **kw))[1]
    try:
        raw = spark.createDataFrame([(message(100, "club_deleted", "k7", "2024-01-02T00:00:00", None, "1"),)], "value string")
        ev.process_batch(ev.parse_events(raw.withColumn("timestamp", F.current_timestamp())), 1, tables)
    finally:
        DataFrameReader.parquet = kept
    states = [p for p in opened if "/silver/" in p and "bucket=" in p]
    assert states == [f"{tables.silver}/version=0/bucket={home}"]
    last = tables.state_parts(spark, table=tables.gold)
    assert {b for b, v in last.items() if v != first[b]} == {home} and last[home] == 1
    gold = {r.department: (r.nb_active_clubs, r.nb_total_courts) for r in tables.read_gold(spark).collect()}
    assert gold == {"0": (14, 14), "1": (12, 12), "2": (13, 13)}


def test_a_group_whose_clubs_are_all_deleted_is_gone(spark):
    path, tables = new_path(spark, "in"), ev.EventTables(new_path(spark, "t"), buckets=2)
    for i, kind in enumerate(("club_created", "club_deleted")):
        offer(spark, path, [message(i, kind, "a", f"2024-01-0{i + 1}T00:00:00", 3, "75")])
        consume(spark, path, tables)
        notes = spark.read.parquet(tables.summary).orderBy(F.desc("id")).first()
        assert (tables.read_gold(spark).count(), notes.active_clubs, notes.events_batch) == (1 - i, 1 - i, 1)


def test_gold_parts_add_up_to_the_rollup(spark):
    rows = [(f"k{i}", "club_deleted" if i % 4 == 0 else "club_created", None if i % 5 == 0 else str(i % 3), None if i % 7 == 0 else i) for i in range(60)]
    state = spark.createDataFrame(rows, "club_id string, event_type string, department string, courts int").withColumn("event_timestamp", F.current_timestamp())
    state = state.withColumn("bucket", F.abs(F.hash("club_id")) % 5)
    got = {r.department: (r.nb_active_clubs, r.nb_total_courts) for r in ev.merged_gold(ev.gold_parts(state)).collect()}
    assert got == {r.department: (r.nb_active_clubs, r.nb_total_courts) for r in ev.gold_by(ev.active(state)).collect()}
