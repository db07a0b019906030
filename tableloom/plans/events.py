"""Stream, topic, run-log and layout queries over the events table."""

from pyspark.sql import functions as F

from tableloom.operators import layout, relational as rel, runlog, topics
from tableloom.plans.registry import query
from tableloom.session import scratch
from tableloom.streaming import streams


def is_error():
    return F.col("event_type") == "error"


#: Events arrive in this many parts, by day of the month; each part is one start of the query.
PARTS = 3
PART_SQL = "CAST(least(floor((day(ts) - 1) / 10), 2) AS BIGINT)"


def run(t, build, mode="append"):
    """Output of a streaming query that is started once for each part that has arrived, on one checkpoint.

    ``build`` makes the query from the stream of events; it may open it twice.
    """
    folder, out, checkpoint = (scratch(t.spark, label) for label in ("events", "out", "checkpoint"))
    part = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(PARTS - 1))

    def stream():
        return streams.event_time(streams.open_stream(t.spark, folder, t.events.schema), "ts")

    for k in range(PARTS):
        t.events.filter(part == k).write.mode("append").parquet(folder)
        done = streams.run_available(build(stream), out, checkpoint, mode)
    return done


def text_time(column):
    return F.col(column).cast("timestamp_ntz").cast("string").alias(column)


@query("r1_stream_filter", "SELECT event_id, upper(event_type) AS kind, value FROM events WHERE value > 20")
def _(t):
    return run(t, lambda stream: stream().filter("value > 20").select("event_id", F.upper("event_type").alias("kind"), "value")).drop("batch_id")


@query("r2_batch_counts", f"SELECT {PART_SQL} AS batch_id, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2")
def _(t):
    return streams.batch_counts(run(t, lambda stream: stream().select("event_type")), "event_type")


@query("r3_running_counts", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def _(t):
    return streams.latest(run(t, lambda stream: streams.running_counts(stream(), "event_type"), "update"), ["event_type"])


@query("r4_last_n_batches", f"SELECT event_type, COUNT(*) AS n FROM events WHERE {PART_SQL} > 0 GROUP BY 1")
def _(t):
    stored = run(t, lambda stream: stream().select("event_id", "event_type"))
    return streams.last_n_batches(stored, 2).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


@query("r5_tumbling", f"""
SELECT {STAMP.format('w')} AS window_start, {STAMP.format('w + INTERVAL 1 HOUR')} AS window_end, event_type, COUNT(*) AS n FROM (SELECT date_trunc('hour', ts) AS w, event_type FROM events) GROUP BY ALL""")
def _(t):
    return streams.windowed_counts(t.events, "ts", ["event_type"], "1 hour").withColumns({
        c: F.col(c).cast("string") for c in ("window_start", "window_end")})


@query("r6_sliding", f"""
SELECT {STAMP.format('w')} AS window_start, {STAMP.format('w + INTERVAL 10 MINUTE')} AS window_end, event_type, COUNT(*) AS n FROM
 (SELECT time_bucket(INTERVAL 5 MINUTE, ts) - k * INTERVAL 5 MINUTE AS w, event_type FROM events, (VALUES (0), (1)) AS v(k)) GROUP BY ALL""")
def _(t):
    return streams.windowed_counts(t.events, "ts", ["event_type"], "10 minutes", "5 minutes").withColumns({
        c: F.col(c).cast("string") for c in ("window_start", "window_end")})


MICRO_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"


@query("r7_sessions", f"""
SELECT user_id, {MICRO_STAMP.format('MIN(ts)')} AS session_start, {MICRO_STAMP.format('MAX(ts)')} AS last_event, COUNT(*) AS n FROM (
 SELECT *, SUM(o) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS o FROM events)) GROUP BY user_id, s""")
def _(t):
    found = streams.sessions(t.events, "ts", "user_id", 6 * 3600)
    return found.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("session_start", "last_event")})


@query("r8_late_split", "SELECT event_id, ts < (SELECT MAX(ts) FROM events) - INTERVAL 2 DAY AS is_late FROM events")
def _(t):
    return streams.late_split(t.events, "ts", 2 * 86400).select("event_id", "is_late")


@query("r9_append_counts", f"""
SELECT {STAMP.format('w')} AS window_start, event_type, COUNT(*) AS n FROM (SELECT date_trunc('hour', ts) AS w, event_type FROM events)
WHERE w + INTERVAL 1 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY ALL""")
def _(t):
    # Windows that end after the last watermark stay open on a stream.
    closed = run(t, lambda stream: streams.windowed_counts(stream(), "ts", ["event_type"], "1 hour", delay="10 minutes"))
    return closed.select(text_time("window_start"), "event_type", "n")


@query("r10_complete_stats", "SELECT user_id, COUNT(*) AS n, ROUND(AVG(value), 9) AS mean_value, COUNT(*) FILTER (WHERE event_type = 'error') AS errors FROM events GROUP BY 1")
def _(t):
    done = run(t, lambda stream: streams.endpoint_stats(stream(), "user_id", "value", is_error()), "complete")
    return streams.last_complete(done).withColumn("mean_value", F.round("mean_value", 9))


@query("r11_hourly", f"""
SELECT {STAMP.format("date_trunc('hour', ts)")} AS hour, COUNT(*) AS requests, COUNT(*) FILTER (WHERE event_type = 'error') AS errors, COUNT(DISTINCT user_id) AS users FROM events GROUP BY 1""")
def _(t):
    seen = run(t, lambda stream: streams.hourly_by_user(stream(), "ts", "user_id", is_error(), "1 day"), "update")
    hours = streams.hourly_totals(streams.latest(seen, ["hour", "user_id"]), "user_id")
    return hours.withColumn("hour", F.col("hour").cast("timestamp_ntz").cast("string"))


@query("r12_keyed_state", "SELECT user_id, COUNT(*) AS n, MAX(value) AS top FROM events GROUP BY 1")
def _(t):
    # Nobody is idle for so long here; the state of one who is would go.
    done = run(t, lambda stream: streams.expiring_totals(stream(), "user_id", "value", "ts", "10 minutes", 60 * 86400), "update")
    return streams.latest(done, ["user_id"]).select("user_id", "n", "top")


# A row without a partner is out once no partner can come: both streams have passed its hour by the delay.
PASSED = "least((SELECT MAX(ts) FROM events JOIN customer ON user_id = c_custkey), (SELECT MAX(ts) FROM events WHERE event_type = 'purchase')) - INTERVAL 10 MINUTE"


@query("r13_stream_joins", f"""
SELECT e.event_id, c_mktsegment, r.value AS acked FROM events e JOIN customer ON user_id = c_custkey
LEFT JOIN events r ON r.event_id = e.event_id AND r.event_type = 'purchase' WHERE r.event_id IS NOT NULL OR e.ts + INTERVAL 1 HOUR < {PASSED}""")
def _(t):
    segments = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment")

    def joined(stream):
        left = streams.join_static(stream().select("event_id", "ts", "user_id"), segments, ["user_id"])
        acks = stream().filter("event_type = 'purchase'").select("event_id", F.col("ts").alias("ack_ts"), F.col("value").alias("acked"))
        return streams.join_streams(left, acks, "event_id", "ts", "ack_ts", "10 minutes", "1 HOUR", "leftOuter")

    return run(t, joined).select("event_id", "c_mktsegment", "acked")


@query("r14_restart", "SELECT event_id, value FROM events")
def _(t):
    # The query is started anew for each part on one checkpoint, and finds only what is new.
    return run(t, lambda stream: stream().select("event_id", "value")).drop("batch_id")


# --- topics ---------------------------------------------------------------------------

ROUTED = """SELECT event_id, ts, CAST(user_id AS STRING) AS user, event_type, value,
 CASE event_type WHEN 'error' THEN 'critical' WHEN 'purchase' THEN 'high_priority' WHEN 'signup' THEN 'low_priority' ELSE 'normal' END AS priority,
 CASE user_id % 4 WHEN 0 THEN 'north_america' WHEN 1 THEN 'europe' WHEN 2 THEN 'asia' ELSE 'elsewhere' END AS region FROM {events}"""
ROUTED_SQL = "(" + ROUTED.format(events="events") + ")"


def routed(t):
    return t.spark.sql(ROUTED, events=t.events)


def md5_mod(key, n):
    """md5 as a number modulo n, from its four 32-bit words."""
    r = pow(2, 32, n)
    out = "0"
    for i in range(4):
        out = f"(({out}) * {r} + CAST('0x' || substr(md5({key}), {8 * i + 1}, 8) AS UBIGINT) % {n}) % {n}"
    return f"CAST({out} AS INT)"


PLACES_SQL = f"""(SELECT *, {md5_mod('"user"', 6)} AS h6, {md5_mod('"user"', 2)} AS h2, CAST((row_number() OVER (ORDER BY event_id) - 1) % 6 AS INT) AS rr FROM {ROUTED_SQL})"""


@query("r15_assign_partition", f"""
SELECT how, partition, COUNT(*) AS n FROM (
 SELECT 'hash' AS how, h6 AS partition FROM {PLACES_SQL} UNION ALL SELECT 'round_robin', rr FROM {PLACES_SQL}
 UNION ALL SELECT 'priority', CASE priority WHEN 'critical' THEN 0 WHEN 'high_priority' THEN 1 + h2 WHEN 'normal' THEN 3 + h2 ELSE 5 END FROM {PLACES_SQL}
 UNION ALL SELECT 'region', CASE region WHEN 'north_america' THEN h2 WHEN 'europe' THEN 2 + h2 WHEN 'asia' THEN 4 + h2 ELSE h6 END FROM {PLACES_SQL}) GROUP BY ALL""")
def _(t):
    r = routed(t)
    placed = [topics.assign_partition(r, how, "user", route, ["event_id"]).select(F.lit(how).alias("how"), "partition")
              for how, route in (("hash", None), ("round_robin", None), ("priority", "priority"), ("region", "region"))]
    every = placed[0].unionByName(placed[1]).unionByName(placed[2]).unionByName(placed[3])
    return every.groupBy("how", "partition").agg(F.count(F.lit(1)).alias("n"))


def event_log(t):
    r = topics.assign_partition(routed(t), "hash", "user").select("event_id", "ts", "partition", "value")
    return topics.with_offset(r, ["ts", "event_id"])


LOG_SQL = f'(SELECT event_id, ts, h6 AS "partition", value, row_number() OVER (PARTITION BY h6 ORDER BY ts, event_id) - 1 AS "offset" FROM {PLACES_SQL})'


@query("r16_offsets", f'SELECT event_id, "partition", "offset" FROM {LOG_SQL}')
def _(t):
    return event_log(t).select("event_id", "partition", "offset")


# Commits: every purchase-sized record commits its own offset; partition 5 never commits.
HISTORY_SQL = f"""(SELECT 'readers' AS group_id, "partition", "offset", ts FROM {LOG_SQL} WHERE value < 5 AND "partition" < 5)"""


def commit_history(log):
    return log.filter("value < 5 AND partition < 5").select(F.lit("readers").alias("group_id"), "partition", "offset", "ts")


COMMITTED_SQL = f"""(SELECT group_id, "partition", arg_max("offset", ts) AS committed FROM {HISTORY_SQL} GROUP BY 1, 2)"""


@query("r17_lag", f"""
SELECT l."partition", MAX("offset") + 1 AS latest, MAX("offset") + 1 - COALESCE(MAX(committed), 0) AS lag FROM {LOG_SQL} l LEFT JOIN {COMMITTED_SQL} c ON l."partition" = c."partition" GROUP BY 1""")
def _(t):
    log = event_log(t)
    return topics.lag(log, topics.committed(commit_history(log)))


@query("r18_read_from", f"""
SELECT event_id, l."partition", "offset" FROM {LOG_SQL} l LEFT JOIN (SELECT "partition", "offset" // 2 AS start FROM (SELECT "partition", committed AS "offset" FROM {COMMITTED_SQL})) c ON l."partition" = c."partition"
WHERE "offset" >= COALESCE(start, 0) AND "offset" < COALESCE(start, 0) + 100""")
def _(t):
    log = event_log(t)
    sought = topics.committed(commit_history(log)).withColumn("committed", F.floor(F.col("committed") / 2))
    return topics.read_from(log, sought, 100).select("event_id", "partition", "offset")


@query("r19_committed", f"SELECT * FROM {COMMITTED_SQL}")
def _(t):
    return topics.committed(commit_history(event_log(t)))


#: Accepted requests per client and seconds that they count for.
LIMIT, SECONDS = 5, 60

# Events 4,000 times as fast, so that clients do reach the limit. The state of a client is its accepted times.
FAST_SQL = "(SELECT user_id, event_id, epoch_us(ts) // 4000 AS us FROM events)"


@query("r20_rate_limit", f"""
WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS rn FROM {FAST_SQL}),
w AS (SELECT user_id, event_id, rn, [us] AS held, TRUE AS accepted FROM o WHERE rn = 1 UNION ALL
 SELECT user_id, event_id, rn, CASE WHEN len(live) < {LIMIT} THEN list_append(live, us) ELSE live END, len(live) < {LIMIT} FROM (
  SELECT o.*, list_filter(w.held, lambda x: x >= o.us - {SECONDS} * 1000000) AS live FROM w JOIN o ON o.user_id = w.user_id AND o.rn = w.rn + 1))
SELECT event_id, accepted FROM w""")
def _(t):
    at = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 4000)
    fast = t.events.select("user_id", "event_id", F.timestamp_micros(at.cast("long")).alias("ts"))
    return streams.rate_limit(fast, "user_id", "ts", "event_id", LIMIT, SECONDS)


# --- run logs ---------------------------------------------------------------------------

RUNS_SQL = "(SELECT event_id, ts, event_type AS task_id, value AS duration, CASE WHEN value > 40 THEN 'failed' ELSE 'success' END AS status FROM events)"


def runs(t):
    status = F.when(F.col("value") > 40, "failed").otherwise("success")
    return t.events.select("event_id", "ts", F.col("event_type").alias("task_id"), F.col("value").alias("duration"), status.alias("status"))


@query("l1_success_rate", f"SELECT ROUND(COALESCE(AVG(CASE WHEN status = 'success' THEN 1.0 ELSE 0.0 END) * 100, 100.0), 6) AS success_rate FROM {RUNS_SQL} WHERE ts > (SELECT MAX(ts) FROM events) - INTERVAL 24 HOUR")
def _(t):
    return runlog.success_rate_at_end(runs(t)).withColumn("success_rate", F.round("success_rate", 6))


@query("l2_avg_duration", f"SELECT task_id, ROUND(AVG(duration), 9) AS avg_duration FROM {RUNS_SQL} GROUP BY 1")
def _(t):
    return runlog.avg_duration(runs(t)).withColumn("avg_duration", F.round("avg_duration", 9))


@query("l3_sla_misses", f"SELECT event_id, task_id, duration FROM {RUNS_SQL} WHERE duration > 30")
def _(t):
    return runlog.sla_misses(runs(t), 30).select("event_id", "task_id", "duration")


@query("l4_recent_runs", f"SELECT event_id, task_id, status FROM {RUNS_SQL} ORDER BY ts DESC, event_id DESC LIMIT 10")
def _(t):
    return runlog.recent_runs(runs(t), 10, "event_id").select("event_id", "task_id", "status")


@query("l5_query_report", f"""
SELECT COUNT(*) AS queries_run, ROUND(SUM(duration), 4) AS total_elapsed_s, ROUND(SUM(duration) / COUNT(*) * 1000, 2) AS avg_elapsed_ms,
 (SELECT event_id FROM events ORDER BY value DESC, event_id DESC LIMIT 1) AS slowest_query, (SELECT event_id FROM events ORDER BY value, event_id LIMIT 1) AS fastest_query FROM {RUNS_SQL}""")
def _(t):
    return runlog.query_report(runs(t), "event_id", "duration")


# --- layout and user functions ------------------------------------------------------------

@query("g23_salted_agg", "SELECT event_type, COUNT(*) AS n, ROUND(SUM(value), 2) AS total, MAX(value) AS top FROM events GROUP BY 1")
def _(t):
    done = layout.salted_agg(t.events, ["event_type"], "event_id", {
        "n": (F.count, "value", F.sum), "total": (F.sum, "value", F.sum), "top": (F.max, "value", F.max)})
    return done.withColumn("total", F.round("total", 2))


@query("u1_user_function", "SELECT event_id, value * 0.5 + 1 AS score FROM events")
def _(t):
    score = layout.scalar_function(lambda v: v * 0.5 + 1, "double")
    return t.events.select("event_id", score("value").alias("score"))


@query("u2_user_reduce", "SELECT event_type, MAX(value) AS value FROM events GROUP BY 1")
def _(t):
    return rel.reduce_by_key(t.events, "event_type", "value", lambda a, b: a if a >= b else b)


@query("u3_foreach", "SELECT COUNT(*) AS seen FROM events")
def _(t):
    seen = t.spark.sparkContext.accumulator(0)
    streams.foreach_batches(t.events.select("event_id"), lambda batch: seen.add(batch.num_rows))
    return t.spark.range(1).select(F.lit(seen.value).cast("long").alias("seen"))


@query("u4_partition_sizes", f"""
SELECT 'hash' AS how, CAST({md5_mod('CAST(user_id AS VARCHAR)', 8)} AS VARCHAR) AS part, COUNT(*) AS rows FROM events GROUP BY ALL
UNION ALL SELECT 'range', CAST(least(CAST(floor((value - lo) / ((hi - lo) / 8)) AS INT), 7) AS VARCHAR), COUNT(*) FROM events, (SELECT MIN(value) AS lo, MAX(value) AS hi FROM events) GROUP BY ALL
UNION ALL SELECT 'value', event_type, COUNT(*) FROM events GROUP BY ALL""")
def _(t):
    kinds = {"hash": layout.hash_partition("user_id", 8), "range": layout.range_partition(t.events, "value", 8), "value": F.col("event_type")}
    sized = [layout.partition_sizes(t.events, part).select(F.lit(how).alias("how"), F.col("part").cast("string").alias("part"), "rows")
             for how, part in kinds.items()]
    return sized[0].unionByName(sized[1]).unionByName(sized[2])


@query("u4_task_sizes")
def _(t):
    return layout.task_sizes(layout.spread(t.events, "range", ["value"], 8))


@query("u5_cached", "SELECT event_type, COUNT(*) AS n, MAX(value) AS top FROM events GROUP BY 1")
def _(t):
    with layout.cached(t.events.select("event_type", "value")) as kept:
        counts = kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        tops = kept.groupBy("event_type").agg(F.max("value").alias("top"))
        # Stored while the cache is held, so that both branches read it once.
        path = scratch(t.spark, "cached")
        counts.join(tops, "event_type").write.parquet(path)
    return t.spark.read.parquet(path)
