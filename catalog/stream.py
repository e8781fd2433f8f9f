"""The event stream, run over the events table written as files of JSON messages."""

from pyspark.sql import functions as F

from catalog.base import query, table
from placerank.session import new_path
from placerank.sources.readers import read_events
from placerank.streaming import events as ev


def write_messages(spark, d, parts=6):
    """One JSON message per line: some garbage, some of an unknown type, some without a key or a time."""
    e = table(spark, d, "events")
    kind = (
        F.when(F.col("event_type") == "signup", "club_created").when(F.col("event_type") == "error", "club_deleted")
        .when(F.col("event_type") == "purchase", "club_viewed").otherwise("club_updated")
    )
    time = F.when(F.col("value") < 1, F.lit("soon")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    message = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("event_id"), kind.alias("event_type"),
            F.when(F.col("value") < 200, F.concat(F.lit("c"), F.col("user_id").cast("string"))).alias("club_id"),
            F.concat(F.lit("Club "), F.col("user_id").cast("string")).alias("name"), F.lit("Ville").alias("city"),
            (F.col("user_id") % 11).cast("string").alias("department"), F.lit(48.1).alias("latitude"), F.lit(2.2).alias("longitude"),
            F.when(F.col("event_type") != "view", F.regexp_extract("props", r"(\d+)", 1).try_cast("int")).alias("courts"),
            F.lit("test").alias("source"), time.alias("event_time"),
        )
    )
    text = F.when(F.col("value").between(60, 62), F.lit("{broken")).otherwise(message)
    path = new_path(spark, "messages")
    # spread over the files by key hash, so that batches see events out of order
    e.select(text.alias("value"), "event_id").repartition(parts, "event_id").select("value").write.text(path)
    return path


MESSAGES_SQL = """msg AS (SELECT event_id::VARCHAR AS event_id, user_id, 'c' || user_id AS club_id, user_id % 11 AS dep,
  CASE event_type WHEN 'signup' THEN 'club_created' WHEN 'error' THEN 'club_deleted' ELSE 'club_updated' END AS event_type,
  CASE WHEN event_type <> 'view' THEN regexp_extract(props, '(\\d+)', 1)::INTEGER END AS courts, CASE WHEN value >= 1 THEN ts END AS t
  FROM events WHERE event_type <> 'purchase' AND value < 200 AND value NOT BETWEEN 60 AND 62),
cur AS (SELECT * FROM (FROM msg QUALIFY row_number() OVER (PARTITION BY club_id ORDER BY t DESC NULLS LAST, event_id DESC) = 1)
  WHERE event_type <> 'club_deleted')"""


def run(spark, d, per_batch="2"):
    tables = ev.EventTables(new_path(spark, "stream"), buckets=8)
    raw = read_events(spark, "text", write_messages(spark, d), maxFilesPerTrigger=per_batch)
    ev.run_stream(raw, tables, once=True)
    return tables


@query(f"""WITH {MESSAGES_SQL} SELECT club_id, event_id, event_type, dep::VARCHAR AS department, courts, strftime(t, '%Y-%m-%d %H:%M:%S.%f') AS event_time FROM cur""")
def stream_latest_state(spark, d):
    silver = run(spark, d).read_silver(spark)
    return silver.select(
        "club_id", "event_id", "event_type", "department", "courts",
        F.date_format("event_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
    )


@query(f"""WITH {MESSAGES_SQL} SELECT dep::VARCHAR AS department, count(DISTINCT club_id) AS nb_active_clubs, sum(coalesce(courts, 0))::BIGINT AS nb_total_courts,
  strftime(max(t), '%Y-%m-%d %H:%M:%S.%f') AS last_event_time FROM cur GROUP BY dep""")
def stream_gold(spark, d):
    gold = run(spark, d).read_gold(spark)
    return gold.withColumn("last_event_time", F.date_format("last_event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query(f"""WITH {MESSAGES_SQL} SELECT (SELECT count(*) FROM msg) AS bronze, (SELECT count(*) FROM cur) AS silver, (SELECT count(*) FROM events) - (SELECT count(*) FROM msg) AS rejects""")
def stream_replay(spark, d):
    """The same messages offered again under the same checkpoint change nothing."""
    tables = ev.EventTables(new_path(spark, "stream"), buckets=8)
    path = write_messages(spark, d)
    for _ in range(2):
        ev.run_stream(read_events(spark, "text", path, maxFilesPerTrigger="3"), tables, once=True)
    counts = {
        "bronze": tables.read_bronze(spark), "silver": tables.read_silver(spark),
        "rejects": spark.read.schema(ev.STATE_SCHEMA).parquet(tables.rejects),
    }
    return spark.range(1).select(*[df.agg(F.count("*").alias("n")).scalar().alias(n) for n, df in counts.items()])


@query(f"""WITH {MESSAGES_SQL} SELECT (SELECT count(*) FROM msg) AS events_logged, (SELECT count(*) FROM cur) AS active_clubs, (SELECT count(DISTINCT dep) FROM cur) AS departments""")
def stream_summary(spark, d):
    tables = run(spark, d)
    notes = spark.read.parquet(tables.summary)
    last = F.max_by(F.struct("active_clubs", "departments"), "id").alias("last")
    return notes.agg(F.sum("events_batch").alias("events_logged"), last).select("events_logged", "last.*")


@query(f"""WITH {MESSAGES_SQL}, u AS (SELECT event_id::VARCHAR AS event_id FROM events WHERE value NOT BETWEEN 60 AND 62)
SELECT (SELECT count(*) FROM events) AS messages, (SELECT count(*) FROM u) AS parsed, (SELECT count(*) FROM msg) AS valid,
  (SELECT count(*) FROM msg WHERE t IS NULL) AS without_time""")
def stream_parse(spark, d):
    raw = spark.read.text(write_messages(spark, d)).withColumn("timestamp", F.current_timestamp())
    parsed = ev.parse_events(raw)
    good, _ = ev.split_valid(parsed)
    row = parsed.agg(F.count("*").alias("messages"), F.count("event_id").alias("parsed"))
    valid = good.agg(F.struct(F.count("*").alias("n"), F.count_if(F.col("event_timestamp").isNull()).alias("t")).alias("s")).scalar()
    return row.select("messages", "parsed", valid["n"].alias("valid"), valid["t"].alias("without_time"))
