"""Streaming operators over the event table as a file stream, run until all available rows are processed."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog import query
from catalog.base import Tables, h, sql_h
from tallyfold.scale import fresh_path
from tallyfold.streaming import monitor


def event_stream(spark, d) -> DataFrame:
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))  # a watermark needs an instant


#: Batches of the disordered stream, days of a batch, and days by which a row may come late.
BATCHES, DAYS, LATE_DAYS = 4, 8, 2
LATENESS = "3 days"
#: Rows of the stream for each file of a batch.
FILE_ROWS = 1_000_000


def disordered_stream(spark, d) -> DataFrame:
    """The events in several batches, in which a row may come up to LATE_DAYS days behind later ones."""
    events = Tables(spark, d).raw("events").withColumn("ts", F.col("ts").cast("timestamp"))
    day = F.floor((F.unix_micros("ts") - F.lit(1704067200000000)) / F.lit(86400000000))
    batch = F.least(F.lit(BATCHES - 1), F.floor((day + h("late", F.col("event_id").cast("string")) % (LATE_DAYS + 1)) / DAYS))
    path = fresh_path(spark, "disordered")
    files = max(2, events.count() // FILE_ROWS)  # of a batch
    for k in range(BATCHES):  # the source takes files by their time
        events.where(batch == k).repartition(files).write.parquet(f"{path}/{k}")
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)


#: Rows that the last watermark has passed.
PASSED = "(SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 3 DAY FROM events)"


def drain(df: DataFrame, name: str) -> DataFrame:
    """Append the stream to parquet files, wait for all available input, return the files."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    q = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/checkpoint").trigger(
        availableNow=True).start(f"{path}/out")
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{path}/out")


def text_time(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)


@query("i1_stale_heartbeats", """
WITH n AS (SELECT user_id, ts, lead(ts) OVER w AS nxt, lag(ts) OVER w AS prv FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT user_id, ts, nxt, sum((prv IS NULL OR ts - prv > INTERVAL 12 HOUR)::INT) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM n),
g AS (SELECT user_id, sid, max(ts) AS last_beat, count(*) AS beats FROM s GROUP BY 1, 2)
SELECT user_id, strftime(last_beat, '%Y-%m-%d %H:%M:%S.%f') AS last_beat, strftime(last_beat + INTERVAL 12 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS stale_at, beats FROM g WHERE last_beat + INTERVAL 12 HOUR <= (SELECT max(ts) FROM events)""")
def i1(spark, d):
    out = drain(monitor.stale_heartbeats(event_stream(spark, d), ["user_id"], max_age="12 hours"), "stale")
    return out.select("user_id", text_time("last_beat"), text_time("stale_at"), "beats")


@query("i1_heartbeat_state", """
WITH l AS (SELECT user_id, max(ts) AS last_beat FROM events WHERE event_type = 'view' GROUP BY 1), j AS (SELECT DISTINCT user_id FROM events UNION SELECT c_custkey FROM customer)
SELECT user_id, strftime(last_beat, '%Y-%m-%d %H:%M:%S.%f') AS last_beat, coalesce(epoch(TIMESTAMP '2024-01-30 12:00:00') - epoch(last_beat) > 86400, true) AS stale FROM j LEFT JOIN l USING (user_id)""")
def i1_batch(spark, d):
    t = Tables(spark, d)
    e = t.raw("events").withColumn("ts", F.col("ts").cast("timestamp"))
    jobs = e.select("user_id").union(t.raw("customer").select("c_custkey"))
    now = F.lit("2024-01-30 12:00:00").cast("timestamp")
    out = monitor.heartbeat_state(jobs, e.where("event_type = 'view'"), ["user_id"], now, 86400)
    return out.select("user_id", text_time("last_beat"), "stale")


JOBS = f"""j AS (SELECT DISTINCT user_id AS job, 't' || user_id % 5 AS expected_token FROM events), r AS (SELECT user_id AS job, event_id, 't' || CASE WHEN {sql_h("'tok:' || event_id")} % 4 = 0 THEN (user_id + 1) % 5 ELSE user_id % 5 END AS token,
  CASE WHEN event_type = 'error' THEN 'oom' ELSE 'ok' END AS exit_reason FROM events)"""


@query("i2_fenced_results", f"WITH {JOBS} SELECT job, event_id, CASE WHEN token <> expected_token THEN 'token_mismatch' WHEN exit_reason <> 'ok' THEN 'rejected_exit' ELSE 'ingested' END AS status, token = expected_token AND exit_reason = 'ok' AS accepted FROM r JOIN j USING (job)")
def i2(spark, d):
    u = F.col("user_id")
    token = F.concat(F.lit("t"), F.when(h("tok", F.col("event_id").cast("string")) % 4 == 0, (u + 1) % 5).otherwise(u % 5).cast("string"))
    stream = event_stream(spark, d).select(u.alias("job"), "event_id", token.alias("token"), F.when(F.col("event_type") == "error", "oom").otherwise("ok").alias("exit_reason"))
    jobs = Tables(spark, d).raw("events").select(u.alias("job")).distinct().withColumn("expected_token", F.concat(F.lit("t"), (F.col("job") % 5).cast("string"))).withColumn("stale", F.lit(False))
    return drain(monitor.fenced_results(stream, jobs), "fenced").select("job", "event_id", "status", "accepted")


@query("i2_missing_results", """
SELECT c_custkey AS job, CASE WHEN c_custkey % 2 = 0 THEN 'heartbeat_stale' ELSE 'missing_result' END AS status FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)""")
def i2_missing(spark, d):
    t = Tables(spark, d)
    jobs = t.raw("customer").select(F.col("c_custkey").alias("job"), (F.col("c_custkey") % 2 == 0).alias("stale"))
    return monitor.missing_results(jobs, t.raw("events").select(F.col("user_id").alias("job")))


@query("i3_first_write_wins", f"""
SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1 AND date_trunc('milliseconds', ts) < {PASSED}""")
def i3(spark, d):
    stream = disordered_stream(spark, d).select("user_id", "event_type", "ts", "event_id", "value")
    return drain(monitor.first_write_wins(stream, ["user_id", "event_type"], ["ts", "event_id"], LATENESS), "first").select("user_id", "event_type", "event_id", "value")


@query("i3_last_write_wins", """
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1""")
def i3_last(spark, d):
    stream = disordered_stream(spark, d).select("user_id", "event_type", "ts", "event_id", "value")
    changes = drain(monitor.last_writes(stream, ["user_id", "event_type"], ["ts", "event_id"]), "last")
    return monitor.last_write_wins(changes, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


THRU = """SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start, n, quarantined, round(n / {m}.0::DOUBLE, 2) AS per_minute FROM ({src}) WHERE w + INTERVAL {m} MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""


@query("i4_window_throughput", THRU.format(m=60, src="SELECT time_bucket(INTERVAL 1 HOUR, ts) AS w, count(*) AS n, count(*) FILTER (event_type = 'error') AS quarantined FROM events GROUP BY 1"))
def i4(spark, d):
    out = drain(monitor.throughput(event_stream(spark, d), quarantined=F.col("event_type") == "error"), "throughput")
    return out.select(text_time("window_start"), "n", "quarantined", "per_minute")


@query("i4_sliding_throughput", THRU.format(m=120, src="SELECT time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR * k AS w, count(*) AS n, count(*) FILTER (event_type = 'error') AS quarantined FROM events, (SELECT unnest([0, 1]) AS k) GROUP BY 1"))
def i4_sliding(spark, d):
    out = drain(monitor.throughput(event_stream(spark, d), window="2 hours", slide="1 hour", quarantined=F.col("event_type") == "error"), "sliding")
    return out.select(text_time("window_start"), "n", "quarantined", "per_minute")


@query("i5_terminal_states", f"""
SELECT event_id // 10 AS kernel, CASE event_type WHEN 'purchase' THEN 'COMPLETE' ELSE 'ERROR' END AS status, event_id FROM events WHERE event_type IN ('purchase', 'error')
QUALIFY row_number() OVER (PARTITION BY event_id // 10 ORDER BY ts, event_id) = 1 AND date_trunc('milliseconds', ts) < {PASSED.replace("FROM events", "FROM events WHERE event_type IN ('purchase', 'error')")}""")
def i5(spark, d):
    status = F.when(F.col("event_type") == "purchase", "COMPLETE").when(F.col("event_type") == "error", "ERROR").otherwise("RUNNING")
    stream = disordered_stream(spark, d).select(F.floor(F.col("event_id") / 10).alias("kernel"), status.alias("status"), "ts", "event_id")
    return drain(monitor.terminal_states(stream, "kernel", ["ts", "event_id"], LATENESS), "terminal").select("kernel", "status", "event_id")


@query("i6_failure_breaker", f"""
WITH r AS (SELECT user_id AS run, event_id, ts, count(*) OVER w AS a, sum((event_type = 'error')::INT) OVER w AS b FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT run, event_id AS stopped_at, a AS attempted, b::BIGINT AS rejected FROM r WHERE a >= 10 AND b::DOUBLE / a > 0.2 QUALIFY row_number() OVER (PARTITION BY run ORDER BY a) = 1 AND date_trunc('milliseconds', ts) < {PASSED}""")
def i6(spark, d):
    stream = disordered_stream(spark, d).select(F.col("user_id").alias("run"), "ts", F.col("event_id").alias("attempt"), (F.col("event_type") == "error").alias("rejected"))
    return drain(monitor.breaker(stream, ["run"], "ts", "attempt", lateness=LATENESS), "breaker").select("run", "stopped_at", "attempted", "rejected")
