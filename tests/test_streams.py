"""Streams against the same query on a table, and stateful walks against brute force."""

import pytest
from pyspark.sql import functions as F

from tableloom.operators import layout, runlog, topics
from tableloom.session import scratch
from tableloom.streaming import streams


@pytest.fixture(scope="module")
def events(spark):
    """2000 events in time order; one user has a third of them."""
    user = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 11 + 1)
    at = F.expr("timestamp_ntz'2024-03-30 22:00:00' + make_interval(0, 0, 0, 0, 0, 0, id * 7 + id * id % 5)")
    return spark.range(2000).select("id", at.alias("ts"), user.alias("user"), (F.col("id") * 31 % 97).cast("double").alias("value"),
                                    F.when(F.col("id") % 4 == 0, "error").otherwise("ok").alias("kind"))


@pytest.fixture(scope="module")
def folder(spark, events):
    """The events as four files written one after the other, so that they arrive in time order."""
    path = scratch(spark, "events")
    for i in range(4):
        events.filter(f"id >= {i * 500} AND id < {(i + 1) * 500}").coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture
def stream(spark, events, folder):
    return streams.event_time(streams.open_stream(spark, folder, events.schema, files_per_batch=1), "ts")


def run(spark, df, mode="append"):
    return streams.run_available(df, scratch(spark, "out"), scratch(spark, "checkpoint"), mode)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_batches_and_running_counts(spark, events, stream):
    stored = run(spark, stream.select("id", "kind"))
    per_batch = rows(streams.batch_counts(stored, "kind"), "batch_id", "kind", "n")
    assert per_batch == [(b, k, n) for b in range(4) for k, n in (("error", 125), ("ok", 375))]
    assert rows(streams.last_n_batches(stored, 2), "id") == [(i,) for i in range(1000, 2000)]
    done = run(spark, streams.running_counts(stream, "kind"), "update")
    assert done.count() == 8
    assert rows(streams.latest(done, ["kind"]), "kind", "n") == [("error", 500), ("ok", 1500)]


@pytest.mark.parametrize("slide", [None, "5 minutes"])
def test_windows(spark, events, stream, slide):
    table = streams.event_time(events, "ts")
    delay = F.expr("INTERVAL 1 MINUTE")
    newest = table.agg(F.max("ts")).first()[0]
    expected = streams.windowed_counts(table, "ts", ["kind"], "10 minutes", slide).filter(F.col("window_end") <= F.lit(newest) - delay)
    got = run(spark, streams.windowed_counts(stream, "ts", ["kind"], "10 minutes", slide, "1 minute"))
    assert rows(got, "window_start", "kind", "n") == rows(expected, "window_start", "kind", "n")


def test_sessions(spark, events, stream):
    table = events.filter("user > 0")
    plain = table.groupBy(F.session_window("ts", "80 seconds"), "user").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last"))
    got = streams.sessions(table, "ts", "user", 80)
    assert rows(got, "user", "session_start", "last_event", "n") == rows(plain, "user", "first", "last", "n")
    closed = run(spark, streams.session_stream(stream.filter("user > 0"), "ts", "user", "80 seconds", "1 minute"))
    assert set(rows(closed, "user", "n")) <= set(rows(got, "user", "n"))


def test_complete_and_update_modes(spark, events, stream):
    error = F.col("kind") == "error"
    expected = streams.endpoint_stats(events, "user", "value", error)
    got = streams.last_complete(run(spark, streams.endpoint_stats(stream, "user", "value", error), "complete"))
    assert rows(got, "user", "n", "errors") == rows(expected, "user", "n", "errors")
    hours = streams.latest(run(spark, streams.hourly_stats(stream, "ts", "user", error), "update"), ["hour"])
    assert rows(hours, "hour", "requests", "errors") == rows(streams.hourly_stats(streams.event_time(events, "ts"), "ts", "user", error), "hour", "requests", "errors")


def test_keyed_state_spans_batches(spark, events, stream):
    got = streams.latest(run(spark, streams.keyed_totals(stream, "user", "value"), "update"), ["user"])
    expected = events.groupBy("user").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
    assert rows(got, "user", "n", "top") == rows(expected, "user", "n", "top")


def test_joins_and_restart(spark, events, stream, folder):
    names = spark.createDataFrame([(0, "hot"), (1, "one")], "user int, name string")
    assert run(spark, streams.join_static(stream, names, ["user"])).count() == events.join(names, "user").count()
    acks = streams.event_time(streams.open_stream(spark, folder, events.schema, 1), "ts").filter("kind = 'error'") \
        .select("id", F.col("ts").alias("ack_ts"))
    joined = run(spark, streams.join_streams(stream.select("id", "ts"), acks, "id", "ts", "ack_ts", "1 minute", "1 MINUTE"))
    assert joined.count() == 500
    out, checkpoint = scratch(spark, "out"), scratch(spark, "checkpoint")
    for _ in range(2):
        assert streams.run_available(stream.select("id"), out, checkpoint).count() == 2000


def three_starts(spark, events, build, mode):
    """Output of a query started once for each third of the events, on one checkpoint."""
    folder, out, checkpoint = (scratch(spark, x) for x in ("events", "out", "checkpoint"))
    for i in range(3):
        events.filter(f"id >= {i * 700} AND id < {(i + 1) * 700}").write.mode("append").parquet(folder)
        done = streams.run_available(build(streams.event_time(streams.open_stream(spark, folder, events.schema), "ts")), out, checkpoint, mode)
    return done


def test_hourly_users_are_exact_on_a_stream(spark, events):
    error = F.col("kind") == "error"
    seen = three_starts(spark, events, lambda s: streams.hourly_by_user(s, "ts", "user", error, "1 hour"), "update")
    got = streams.hourly_totals(streams.latest(seen, ["hour", "user"]), "user")
    expected = streams.hourly_stats(streams.event_time(events, "ts"), "ts", "user", error)
    columns = "hour", "requests", "errors", "users"
    assert rows(got, *columns) == rows(expected, *columns) and got.count() > 3


def test_state_of_an_idle_key_goes(spark, events):
    """User 1 is seen in the first and last third only, all others throughout; user 2 never comes back."""
    kept = events.filter("(user != 1 OR id < 700 OR id >= 1400) AND (user != 2 OR id < 700)")
    done = three_starts(spark, kept, lambda s: streams.expiring_totals(s, "user", "value", "ts", "1 minute", 1800), "update")
    closed = {r["user"]: r["n"] for r in done.filter("closed").collect()}
    first = {r["user"]: r["n"] for r in kept.filter("id < 700").groupBy("user").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert closed == {1: first[1], 2: first[2]}
    last = {r["user"]: r["n"] for r in streams.latest(done, ["user"]).filter("NOT closed").collect()}
    counts = {r["user"]: r["n"] for r in kept.groupBy("user").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert last == {u: n - first[1] if u == 1 else n for u, n in counts.items() if u != 2}


def test_outer_join_of_streams(spark, events):
    """Rows without a partner come with nulls once both streams have passed their range, and none twice."""
    def joined(s):
        acks = s.filter("kind = 'error'").select("id", F.col("ts").alias("ack_ts"))
        return streams.join_streams(s.select("id", "ts"), acks, "id", "ts", "ack_ts", "1 minute", "1 MINUTE", "leftOuter")

    found = three_starts(spark, events, joined, "append")
    got = {r["id"]: r["ack_ts"] is not None for r in found.collect()}
    assert found.count() == len(got)
    assert {i for i, hit in got.items() if hit} == set(range(0, 2000, 4))
    missing = {i for i in range(2000) if i % 4} - {i for i, hit in got.items() if not hit}
    assert missing and min(missing) > 1960


def brute_force(times, limit, span):
    held, out = [], []
    for at in times:
        held = [h for h in held if h >= at - span]
        out.append(len(held) < limit)
        if out[-1]:
            held.append(at)
    return out


@pytest.mark.parametrize("limit,seconds", [(5, 60), (1, 30), (3, 100000)])
def test_rate_limit(events, limit, seconds):
    got = {r["id"]: r["accepted"] for r in streams.rate_limit(events, "user", "ts", "id", limit, seconds).collect()}
    by_user = {}
    for r in events.orderBy("ts", "id").collect():
        by_user.setdefault(r["user"], []).append((r["ts"].timestamp(), r["id"]))
    for seen in by_user.values():
        assert [got[i] for _, i in seen] == brute_force([a for a, _ in seen], limit, seconds)
    assert len(got) == 2000


@pytest.mark.parametrize("limit,step", [(1, 7), (4, 3), (50, 1)])
def test_rate_limit_of_one_client_in_slices(spark, limit, step):
    """Rows of one client are cut at many places, with ties, calm times, pauses, and overload that no calm time ends."""
    at = F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, floor(id * {step} / 2) + 400 * floor(id / 900) + id % 900 * floor(id / 1800))")
    some = spark.range(2400).select((F.col("id") + (1 << 60)).alias("id"), at.alias("ts"), F.lit(None).cast("string").alias("user"))
    extra = spark.createDataFrame([(1, None, None), (2, None, "x")], "id long, ts timestamp_ntz, user string")
    got = {r["id"]: r["accepted"] for r in streams.rate_limit(some.unionByName(extra), "user", "ts", "id", limit, 60, slices=9, least_rows=1).collect()}
    seen = [(r["ts"].timestamp(), r["id"]) for r in some.orderBy("ts", "id").collect()]
    assert got.pop(1) is None and got.pop(2) is None
    assert [got[i] for _, i in seen] == brute_force([a for a, _ in seen], limit, 60)
    assert len(got) == 2400
    none = streams.rate_limit(some, "user", "ts", "id", 0, 60)
    assert none.filter("NOT accepted").count() == 2400


def test_rate_limit_on_a_stream(spark, events, stream):
    table = {r["id"]: r["accepted"] for r in streams.rate_limit(events, "user", "ts", "id", 3, 90).collect()}
    got = run(spark, streams.rate_limit_stream(stream, "user", "ts", "id", 3, 90))
    assert {r["id"]: r["accepted"] for r in got.collect()} == table


def test_late_split(events):
    marked = streams.late_split(events, "ts", 600)
    newest = events.agg(F.max("ts")).first()[0]
    assert marked.filter("is_late").count() == sum((newest - r["ts"]).total_seconds() > 600 for r in events.collect())


def test_topics(spark, events):
    placed = topics.assign_partition(events, "round_robin", order=["id"], n=3)
    assert rows(placed, "id", "partition") == [(i, i % 3) for i in range(2000)]
    log = topics.with_offset(placed.select("id", "partition", "ts"), ["id"])
    assert rows(log, "id", "offset") == [(i, i // 3) for i in range(2000)]
    history = spark.sql("SELECT 'g' AS group_id, p AS partition, o AS offset, t AS ts FROM VALUES (0, 9, 1), (0, 4, 2), (1, 5, 1) AS h(p, o, t)")
    commits = topics.committed(history)
    assert rows(topics.lag(log, commits), "partition", "latest", "lag") == [(0, 667, 663), (1, 667, 662), (2, 666, 666)]
    assert rows(topics.read_from(log, commits, 2), "partition", "offset") == [(0, 4), (0, 5), (1, 5), (1, 6), (2, 0), (2, 1)]
    routes = spark.createDataFrame([("critical", "k"), ("other", "k")], "r string, key string")
    got = rows(routes.withColumn("p", topics.by_route("r", "key", topics.PRIORITY_ROUTES)), "r", "p")
    assert got[0] == ("critical", 0) and 0 <= got[1][1] < 6


def test_run_log(spark):
    none = spark.createDataFrame([], "ts timestamp, status string")
    assert runlog.success_rate(none, "current_timestamp()").first()[0] == 100.0
    runs = spark.sql("SELECT timestamp'2024-01-03 00:00:00' - make_interval(0, 0, 0, 0, id * 10) AS ts, if(id = 1, 'failed', 'success') AS status FROM range(5)")
    assert runlog.success_rate_at_end(runs, 24).first()[0] == pytest.approx(200 / 3)


def test_layout(spark, events):
    done = layout.salted_agg(events, ["kind"], "id", {"n": (F.count, "value", F.sum), "top": (F.max, "value", F.max)}, salts=4)
    assert rows(done, "kind", "n", "top") == [("error", 500, 96.0), ("ok", 1500, 96.0)]
    sizes = layout.partition_sizes(events, layout.range_partition(events, "id", 4))
    assert rows(sizes, "part", "rows") == [(0, 500), (1, 500), (2, 500), (3, 500)]
    assert sum(r["rows"] for r in layout.task_sizes(layout.spread(events, "hash", ["user"], 5)).collect()) == 2000
    with layout.cached(events) as kept:
        assert kept.is_cached
    assert not events.is_cached
