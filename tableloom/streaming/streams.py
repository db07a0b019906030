"""Event aggregation that reads the same on a table and on a stream.

The functions take a batch or a streaming DataFrame; state and output modes
are Spark's own. Event time must be ``timestamp`` on a stream (see
:func:`event_time`), since watermarks refuse ``timestamp_ntz``.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tableloom.operators.ordered import join_null_safe
from tableloom.session import stored

#: Fewest requests that are worth a slice of their own.
SLICE_ROWS = 65_536


def open_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """A folder of Parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def event_time(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Process what is there, then return all output with its ``batch_id``.

    Each micro-batch overwrites its own folder, so a batch repeated after a
    failure replaces its first attempt and every row is stored once.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    run = (
        stream.writeStream.outputMode(mode).trigger(availableNow=True)
        .option("checkpointLocation", checkpoint).foreachBatch(store).start()
    )
    run.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    return stream.sparkSession.read.schema(schema).parquet(path)


def latest(output: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest row per key of an update-mode output."""
    rest = [c for c in output.columns if c not in (*keys, "batch_id")]
    return output.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("r")).select(*keys, "r.*")


def last_complete(output: DataFrame) -> DataFrame:
    """Rows of the last batch of a complete-mode output."""
    newest = output.agg(F.max("batch_id")).scalar()
    return output.filter(F.col("batch_id") == newest).drop("batch_id")


def batch_counts(output: DataFrame, key: str) -> DataFrame:
    """Count by key within each micro-batch."""
    return output.groupBy("batch_id", key).agg(F.count(F.lit(1)).alias("n"))


def running_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def last_n_batches(output: DataFrame, n: int) -> DataFrame:
    """Rows of the newest ``n`` micro-batches."""
    newest = output.agg(F.max("batch_id")).scalar()
    return output.filter(F.col("batch_id") > newest - n)


def windowed_counts(df: DataFrame, ts: str, keys: Sequence[str], size: str, slide: str | None = None, delay: str | None = None) -> DataFrame:
    """Rows per time window and key; tumbling, or sliding with ``slide``.

    With ``delay`` a watermark lets append mode emit windows once they close.
    """
    timed = df.withWatermark(ts, delay) if delay else df
    return timed.groupBy(F.window(ts, size, slide).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")


def session_stream(df: DataFrame, ts: str, key: str, gap: str, delay: str) -> DataFrame:
    """Session windows of a stream."""
    return df.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), key, "n")


def sessions(df: DataFrame, ts: str, key: str, gap_seconds: int) -> DataFrame:
    """Sessions of a table: rows of a key no more than the gap apart.

    Rows are first merged into slots as wide as the gap, since two rows of
    one slot are never further apart. What is ordered per key is then one row
    per slot, bounded by the time span and not by the number of rows.
    """
    micros = _micros(ts)
    gap = gap_seconds * 1_000_000
    slots = df.groupBy(key, F.floor(micros / gap).alias("slot")).agg(
        F.min(micros).alias("lo"), F.max(micros).alias("hi"), F.min(ts).alias("first"), F.max(ts).alias("last"),
        F.count(F.lit(1)).alias("c"))
    order = Window.partitionBy(key).orderBy("slot")
    opens = F.coalesce(F.col("lo") - F.lag("hi").over(order) > gap, F.lit(True))
    marked = slots.withColumn("opens", opens.cast("int"))
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marked.withColumn("session", F.sum("opens").over(upto)).groupBy(key, "session").agg(
        F.min("first").alias("session_start"), F.max("last").alias("last_event"), F.sum("c").alias("n")).drop("session")


def _micros(ts: str) -> Column:
    """Microseconds of a wall-clock time, whatever the session time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit(datetime(1970, 1, 1)).cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))


def late_split(df: DataFrame, ts: str, delay_seconds: int) -> DataFrame:
    """Mark rows older than the newest event time minus the delay."""
    edge = df.agg(F.max(ts)).scalar() - F.expr(f"INTERVAL {delay_seconds} SECONDS")
    return df.withColumn("is_late", F.col(ts) < edge)


def endpoint_stats(df: DataFrame, key: str, value: str, is_error: Column) -> DataFrame:
    """Count, mean and errors per key, for complete mode."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value"), F.count_if(is_error).alias("errors"))


def hourly_stats(df: DataFrame, ts: str, user: str, is_error: Column) -> DataFrame:
    """Requests, errors and different users per hour, for update mode.

    Users are exact on a table; a stream cannot count distinct values, so
    there they are approximate.
    """
    users = F.approx_count_distinct(user) if df.isStreaming else F.count_distinct(user)
    return df.groupBy(F.date_trunc("hour", ts).alias("hour")).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(is_error).alias("errors"), users.alias("users"))


def hourly_by_user(stream: DataFrame, ts: str, user: str, is_error: Column, delay: str) -> DataFrame:
    """Requests and errors per hour and user, for update mode; ``hourly_totals`` of the newest rows are exact.

    A stream cannot count distinct values, so the state has a row per hour and
    user, which goes when the watermark has passed the hour.
    """
    return stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 hour").alias("w"), user).agg(
        F.count(F.lit(1)).alias("requests"), F.count_if(is_error).alias("errors")).select(F.col("w.start").alias("hour"), user, "requests", "errors")


def hourly_totals(newest: DataFrame, user: str) -> DataFrame:
    """Requests, errors and different users per hour from one row per hour and user; a null user is none."""
    return newest.groupBy("hour").agg(F.sum("requests").alias("requests"), F.sum("errors").alias("errors"), F.count(user).alias("users"))


def keyed_totals(stream: DataFrame, key: str, value: str) -> DataFrame:
    """Custom keyed state: running count and maximum per key, kept across batches.

    Rows are folded to one per key before they are shuffled, so a busy key
    brings a few rows per task to its state. A key with NULL values alone has no
    maximum.
    """
    schema = T.StructType([
        stream.schema[key], T.StructField("n", T.LongType()), T.StructField("top", T.DoubleType())])
    state = T.StructType([T.StructField("n", T.LongType()), T.StructField("top", T.DoubleType())])

    def update(keys: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        n, top = held.get if held.exists else (0, None)
        for batch in batches:
            tops = [x for x in (top, *batch["top"]) if x is not None and x == x]
            n, top = n + int(batch["n"].sum()), max(tops, default=None)
        held.update((n, top))
        yield pd.DataFrame({key: [keys[0]], "n": [n], "top": pd.array([top], "Float64")})

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            grouped = batch.groupby(key, dropna=False)[value]
            yield pd.DataFrame({"n": grouped.size(), "top": grouped.max().astype("Float64")}).reset_index()

    return stream.select(key, F.col(value).cast("double").alias(value)).mapInPandas(fold, schema).groupBy(key).applyInPandasWithState(
        update, schema, state, "update", GroupStateTimeout.NoTimeout)


def expiring_totals(stream: DataFrame, key: str, value: str, ts: str, delay: str, idle_seconds: int) -> DataFrame:
    """Running count and maximum per key, as ``keyed_totals``, whose state goes when a key has been idle.

    A timer is set ``idle_seconds`` after a key's last event. When the watermark passes
    it, a last row marked ``closed`` is put out and the state removed; a key that
    comes back begins anew.
    """
    out = T.StructType([stream.schema[key], T.StructField("n", T.LongType()), T.StructField("top", T.DoubleType()), T.StructField("closed", T.BooleanType())])
    state = T.StructType([T.StructField("n", T.LongType()), T.StructField("top", T.DoubleType()), T.StructField("last", T.LongType())])

    def update(keys: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        n, top, last = held.get if held.exists else (0, None, 0)
        if held.hasTimedOut:
            held.remove()
        else:
            for batch in batches:
                tops = [x for x in (top, *batch["top"]) if x is not None and x == x]
                n, top, last = n + int(batch["n"].sum()), max(tops, default=None), max(last, int(batch["last"].max()))
            held.update((n, top, last))
            held.setTimeoutTimestamp(max(last + 1000 * idle_seconds, held.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({key: [keys[0]], "n": [n], "top": pd.array([top], "Float64"), "closed": [held.hasTimedOut]})

    timed = stream.withWatermark(ts, delay)
    narrow = timed.select(F.col(key), F.col(ts), F.lit(1).cast("long").alias("n"), F.col(value).cast("double").alias("top"), F.unix_millis(ts).alias("last"))
    return narrow.groupBy(key).applyInPandasWithState(update, out, state, "update", GroupStateTimeout.EventTimeTimeout)


def join_static(stream: DataFrame, static: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    return stream.join(static, list(on), how)


def join_streams(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, delay: str, within: str, how: str = "inner") -> DataFrame:
    """Rows of two streams with the same key, the right one at most ``within`` later.

    With ``how="leftOuter"`` a left row without a partner is put out with nulls once
    the watermark has passed its range.
    """
    a = left.withWatermark(left_ts, delay)
    b = right.withColumnRenamed(key, "__key").withWatermark(right_ts, delay)
    near = (F.col(right_ts) >= F.col(left_ts)) & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"INTERVAL {within}"))
    return a.join(b, (F.col(key) == F.col("__key")) & near, how).drop("__key")


def _accepted(at: list[int], held: deque, limit: int, span: int) -> list[int]:
    """Places of the accepted ones among rising times; ``held`` has the last ``limit`` accepted times and is brought up to date."""
    places, i = [], 0
    while i < len(at):
        if len(held) == limit and at[i] <= held[0] + span:
            i = bisect_right(at, held[0] + span, i)
        else:
            held.append(at[i])
            places.append(i)
            i += 1
    return places


def rate_limit(df: DataFrame, client: str, ts: str, unique: str, limit: int, seconds: int,
               slices: int | None = None, least_rows: int = SLICE_ROWS) -> DataFrame:
    """Which requests are accepted: at most ``limit`` accepted ones per client in the last ``seconds``.

    Refused requests do not count, so each decision depends on earlier ones. Time is
    cut into slots as wide as the window. A slot that has at most ``limit`` requests
    together with the slot before it is calm: all of its requests are accepted without
    being walked, and they are all that the next slot needs to know. Only runs of other
    slots are walked in time order. Long runs are cut into slices of a client's
    slots, which are walked side by side; the accepted times at the end of a slice are
    handed to the next one, and slices that were given other times are walked again,
    until none changes. So a slice is right after as many passes as slices of its
    run lie before it, mostly sooner. A task reads its slices in Arrow batches and holds at most
    ``limit`` times. A request without a time is neither accepted nor refused (null).
    """
    spark, span = df.sparkSession, seconds * 1_000_000
    timed = df.select(client, unique, _micros(ts).alias("__at")).withColumn("__slot", F.floor(F.col("__at") / span))
    if limit < 1:
        return timed.select(unique, F.when(F.col("__at").isNotNull(), False).alias("accepted"))

    order = Window.partitionBy(client).orderBy("__slot")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_slot = timed.filter("__slot IS NOT NULL").groupBy(client, "__slot").agg(F.count(F.lit(1)).alias("__c"))
    joined = F.coalesce(F.col("__slot") - F.lag("__slot").over(order) == 1, F.lit(False))
    busy = F.col("__c") + F.when(joined, F.lag("__c").over(order)).otherwise(0) > limit
    slots = stored(per_slot.withColumn("__joined", joined).withColumn("__busy", busy), "rate-slots")

    # Slices of a run begin where its client's busy rows pass a multiple of the slice size.
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = F.greatest(F.lit(least_rows), F.ceil(slots.filter("__busy").agg(F.coalesce(F.sum("__c"), F.lit(0))).scalar() / n))
    mine = F.when(F.col("__busy"), F.col("__c")).otherwise(0)
    counted = slots.withColumn("__cut", F.floor((F.sum(mine).over(upto) - mine) / size))
    opens = F.col("__busy") & ~(F.col("__joined") & F.coalesce(F.lag("__busy").over(order), F.lit(False)))
    begins = opens | (F.col("__busy") & (F.col("__cut") > F.lag("__cut").over(order)))
    marked = counted.withColumn("__opens", opens).withColumn("__begins", F.coalesce(begins, F.lit(False)))
    parts = marked.withColumn("__part", F.sum(F.col("__begins").cast("int")).over(upto))
    fed = F.lead("__opens").over(order) & F.lead("__joined").over(order)
    parts = parts.withColumn("__feeds", F.when(~F.col("__busy") & fed, F.col("__part") + 1))
    parts = stored(parts.withColumn("__part", F.when(F.col("__busy"), F.col("__part"))), "rate-parts")

    where = parts.select(client, "__slot", "__part", "__feeds")
    placed = stored(join_null_safe(timed, where, [client, "__slot"], "left").drop("__slot"), "rate-requests")
    walked, key = placed.filter("__part IS NOT NULL"), [client, "__part"]

    # What each slice begins with: the requests of the calm slot before its run, or nothing as a first guess.
    fed_by = placed.filter("__feeds IS NOT NULL").groupBy(client, F.col("__feeds").alias("__part")).agg(F.sort_array(F.collect_list("__at")).alias("__start"))
    named = parts.filter("__begins").select(client, "__part", (~F.col("__opens")).alias("__follows"))
    followed = F.coalesce(F.lead("__follows").over(Window.partitionBy(client).orderBy("__part")), F.lit(False))
    empty = F.array().cast("array<bigint>")
    starts = stored(join_null_safe(named.withColumn("__followed", followed), fed_by, key, "left").withColumn("__start", F.coalesce("__start", empty)), "rate-starts")

    def lined_up(begun: DataFrame, rows: DataFrame) -> DataFrame:
        """Requests in order of slice and time, each slice led by a row with what it begins with."""
        heads = begun.select(*key, F.lit(-(1 << 63)).alias("__at"), "__start")
        body = rows.withColumn("__start", F.lit(None).cast("array<bigint>"))
        return heads.unionByName(body, allowMissingColumns=True).repartition(*key).sortWithinPartitions(*key, "__at", unique)

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Per batch and slice in it: batch, place of its first request, times, times held; ``None`` held goes on with the slice before."""
        for batch in batches:
            at, begun = batch.column("__at").to_pylist(), batch.column("__start").to_pylist()
            heads = [i for i, s in enumerate(begun) if s is not None]
            bounds = [*heads, len(at)]
            if bounds[0] > 0:
                yield batch, 0, at[:bounds[0]], None
            for i, j in zip(heads, bounds[1:]):
                yield batch, i + 1, at[i + 1:j], deque(begun[i], maxlen=limit)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, whose = deque(), 0, None

        def closed() -> pa.RecordBatch:
            live = pa.array([[h for h in held if h >= last - span]], pa.list_(pa.int64()))
            # What the slice after this one begins with.
            return pa.RecordBatch.from_arrays([whose.column(client), pc.add(whose.column("__part"), 1), live], [client, "__part", "__start"])

        for batch, first, at, begun in stretches(batches):
            if begun is not None:
                if whose is not None:
                    yield closed()
                held, last, whose = begun, 0, batch.slice(first - 1, 1)
            _accepted(at, held, limit, span)
            last = at[-1] if at else last
        if whose is not None:
            yield closed()

    def flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = deque()
        for batch, first, at, begun in stretches(batches):
            held = held if begun is None else begun
            taken = np.zeros(len(at), dtype=bool)
            taken[_accepted(at, held, limit, span)] = True
            yield pa.RecordBatch.from_arrays([batch.column(unique).slice(first, len(at)), pa.array(taken)], [unique, "accepted"])

    handed = T.StructType([df.schema[client], T.StructField("__part", T.LongType()), T.StructField("__start", T.ArrayType(T.LongType()))])
    walk_again = starts.filter("__followed")
    while not walk_again.isEmpty():
        rows = walked.select(*key, "__at").withColumn(unique, F.lit(None).cast(df.schema[unique].dataType))
        asked = join_null_safe(rows, walk_again.select(*key), key, "left_semi")
        told = stored(lined_up(walk_again, asked).mapInArrow(ends, handed), "rate-ends").withColumnRenamed("__start", "__told")
        known = join_null_safe(starts, told, key, "left")
        changed = F.col("__told").isNotNull() & (F.col("__told") != F.col("__start"))
        known = known.withColumn("__changed", changed).withColumn("__start", F.coalesce("__told", "__start"))
        both = stored(known.drop("__told"), "rate-starts")
        starts = both.drop("__changed")
        walk_again = both.filter("__changed AND __followed").drop("__changed")

    schema = T.StructType([df.schema[unique], T.StructField("accepted", T.BooleanType())])
    decided = lined_up(starts, walked.select(*key, "__at", unique)).mapInArrow(flags, schema)
    calm = placed.filter("__part IS NULL").select(unique, F.when(F.col("__at").isNotNull(), True).alias("accepted"))
    return decided.unionByName(calm)


def rate_limit_stream(stream: DataFrame, client: str, ts: str, unique: str, limit: int, seconds: int) -> DataFrame:
    """The same decision on a stream, with the last accepted times as state.

    A task gets at most one micro-batch of a client, however busy it is, so
    the trigger size bounds the work. Times must rise from batch to batch.
    """
    schema = T.StructType([stream.schema[unique], T.StructField("accepted", T.BooleanType())])
    state = T.StructType([T.StructField("held", T.ArrayType(T.LongType()))])
    span = seconds * 1_000_000

    def update(keys: tuple, batches: Iterator[pd.DataFrame], kept: GroupState) -> Iterator[pd.DataFrame]:
        held = list(kept.get[0]) if kept.exists else []
        rows = pd.concat(list(batches)).sort_values(["__at", unique])
        flags = []
        for at in rows["__at"].tolist():
            held = [h for h in held if h >= at - span]
            flags.append(len(held) < limit)
            if flags[-1]:
                held.append(at)
        kept.update((held,))
        yield pd.DataFrame({unique: rows[unique], "accepted": flags})

    timed = stream.select(client, F.unix_micros(ts).alias("__at"), unique)
    return timed.groupBy(client).applyInPandasWithState(update, schema, state, "append", GroupStateTimeout.NoTimeout)


def foreach_rows(df: DataFrame, action: Callable) -> None:
    """Call ``action(row)`` for every row, inside the tasks."""
    def visit(rows) -> None:
        for row in rows:
            action(row)

    df.foreachPartition(visit)


def foreach_batches(df: DataFrame, action: Callable) -> None:
    """Call ``action(batch)`` for every Arrow batch of rows, inside the tasks."""
    def visit(batches) -> Iterator:
        for batch in batches:
            action(batch)
            yield batch.slice(0, 0)

    df.mapInArrow(visit, df.schema).write.format("noop").mode("overwrite").save()
