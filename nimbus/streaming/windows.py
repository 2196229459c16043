"""Event-time streaming operators (T2, T3) and a batch-id keyed sink.

State is bounded by the watermark: windows and dedup keys older than
``max(event_time) - watermark`` are dropped from the state store.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from nimbus.operators.latest import latest_per_key
from nimbus.operators.summary import Metric, dominant


def _event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need ``timestamp``; read ``timestamp_ntz`` as UTC."""
    if df.schema[ts].dataType.typeName() == "timestamp_ntz":
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def hourly_stream(df: DataFrame, keys, ts: str, metrics: list[Metric],
                  label: str | None = None, watermark: str = "2 hours",
                  window: str = "1 hour", label_col: str = "dominant",
                  count_col: str = "reading_count") -> DataFrame:
    """Tumbling-window summary per key (T2); late rows within the watermark
    still update their window."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    aggs = [m.column() for m in metrics]
    if label:
        aggs.append(dominant(label).alias(label_col))
    aggs.append(F.count(F.lit(1)).alias(count_col))
    return (_event_time(df, ts).withWatermark(ts, watermark)
              .groupBy(F.window(ts, window).alias("w"), *keys).agg(*aggs)
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *keys, *[a for a in [m.name for m in metrics]],
                      *([label_col] if label else []), count_col))


def hourly_stream_closed(df: DataFrame, keys, ts: str, metrics: list[Metric], label: str,
                         watermark: str = "2 hours", window: str = "1 hour", label_col: str = "dominant",
                         count_col: str = "reading_count") -> DataFrame:
    """Tumbling-window summary per key, each window once, when the watermark
    has passed it (append mode).

    Two aggregations follow each other: one per label, then the pick of the
    most frequent label (ties: the smallest) and the totals. So no state holds
    a map of labels, however many there are: each row of state is a few
    numbers, and both go when their window closes. ``min``, ``max``, ``sum``,
    ``count`` and ``avg`` metrics; rows without a label count, but are no label.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    of, over = [], []
    for i, m in enumerate(metrics):
        c = F.col(m.col)
        if m.fn in ("min", "max"):
            of.append((F.min if m.fn == "min" else F.max)(c).alias(f"_m{i}"))
            out = (F.min if m.fn == "min" else F.max)(f"_m{i}")
        elif m.fn in ("sum", "count"):
            of.append((F.sum if m.fn == "sum" else F.count)(c).alias(f"_m{i}"))
            out = F.sum(f"_m{i}")
        elif m.fn == "avg":
            of += [F.sum(c).alias(f"_m{i}"), F.count(c).alias(f"_n{i}")]
            out = F.try_divide(F.sum(f"_m{i}"), F.sum(f"_n{i}"))
        else:
            raise ValueError(f"{m.name}: {m.fn} does not combine over labels")
        over.append((F.round(out, m.digits) if m.digits is not None else out).alias(m.name))
    labels = (_event_time(df, ts).withWatermark(ts, watermark)
              .groupBy(F.window(ts, window).alias("w"), *keys, F.col(label).alias("_label"))
              .agg(*of, F.count(F.lit(1)).alias("_rows")))
    # min_by over (-rows, label): the most rows, then the smallest label.
    named = F.col("_label").isNotNull()
    pick = F.min_by("_label", F.when(named, F.struct((-F.col("_rows")).alias("r"), F.col("_label").alias("l"))))
    closed = labels.groupBy("w", *keys).agg(*over, pick.alias(label_col), F.sum("_rows").alias(count_col))
    return closed.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys,
                         *[m.name for m in metrics], label_col, count_col)


def dedup_stream(df: DataFrame, keys, ts: str, watermark: str = "2 hours") -> DataFrame:
    """Drop repeated observations (same keys) arriving within the watermark."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return _event_time(df, ts).withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)


def run_to_table(stream: DataFrame, out: str, checkpoint: str, mode: str = "append",
                 available_now: bool = True) -> StreamingQuery:
    """Write each micro-batch to Parquet tagged with its batch id.

    With ``update`` mode a key can be emitted by several batches; readers
    take the row of the highest batch id (``read_latest``). A replayed batch
    (after a failure) rewrites its own ``batch_id`` folder only.
    """
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    w = (stream.writeStream.outputMode(mode).foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def dedup_to_table(stream: DataFrame, keys: list[str], ts: str, out: str, checkpoint: str,
                   watermark_hours: float = 2, available_now: bool = True) -> StreamingQuery:
    """Write each observation once, and late ones to a side output.

    ``out/accepted`` holds the first copy of every key, ``out/late`` every row
    observed more than ``watermark_hours`` before the latest observation of the
    batches before: nothing is dropped unseen, nothing raises. Copies may come in
    one batch or in different ones. What was accepted is the state: a batch
    is compared with accepted rows of the days its own rows, which are not
    older than the watermark, can repeat. Each batch writes its own folder, so a
    replayed one takes the same decisions again. Copies must agree in
    ``ts`` to within the watermark; NULL keys equal each other.
    """
    schema = stream.schema

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = _event_time(batch, ts).persist()
        try:
            before = _read(spark, f"{out}/_marks", "last timestamp, batch_id long").where(F.col("batch_id") < batch_id)
            last = before.agg(F.date_format(F.max("last"), "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
            mark = None if last is None else F.lit(last).cast("timestamp") - F.make_dt_interval(secs=F.lit(float(watermark_hours) * 3600))
            is_late = F.lit(False) if mark is None else F.coalesce(F.col(ts) < mark, F.lit(False))
            rows.where(is_late).withColumn(ts, F.col(ts).cast(schema[ts].dataType)).write.mode("overwrite").parquet(f"{out}/late/batch_id={batch_id}")
            first = latest_per_key(rows.where(~is_late), keys, [F.col(ts).asc_nulls_last(), F.xxhash64(*[c for c in rows.columns]).asc()])
            if mark is not None:
                held = _read(spark, f"{out}/accepted", schema.add("batch_id", "long").add("day", "date")).where((F.col("batch_id") < batch_id) & (F.col("day") >= F.to_date(mark)))
                known = held.select(*[F.col(k).cast(first.schema[k].dataType).alias(f"_h{i}") for i, k in enumerate(keys)])
                on = [F.col(k).eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(keys)]
                cond = on[0]
                for c in on[1:]:
                    cond = cond & c
                first = first.join(known, cond, "left_anti")
            (first.withColumn("day", F.to_date(ts)).withColumn(ts, F.col(ts).cast(schema[ts].dataType))
             .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("day").parquet(f"{out}/accepted/batch_id={batch_id}"))
            rows.agg(F.max(ts).alias("last")).write.mode("overwrite").parquet(f"{out}/_marks/batch_id={batch_id}")
        finally:
            rows.unpersist()

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        return spark.createDataFrame([], schema)


def deduplicated(spark: SparkSession, out: str, schema) -> tuple[DataFrame, DataFrame]:
    """The accepted and the late rows of ``dedup_to_table``."""
    names = [f.name for f in schema.fields]
    return tuple(_read(spark, f"{out}/{side}", schema).select(*names) for side in ("accepted", "late"))


def read_latest(spark: SparkSession, out: str, keys) -> DataFrame:
    """Final state of an update-mode output: the newest batch's row per key."""
    df = spark.read.parquet(out)
    return latest_per_key(df, list(keys), [F.col("batch_id").desc()]).drop("batch_id")


def compact(spark: SparkSession, out: str, into: str, keys) -> DataFrame:
    """Write the final state of an update-mode output as one table, so that
    later readers do not sort through every update ever emitted."""
    read_latest(spark, out, keys).write.mode("overwrite").parquet(into)
    return spark.read.parquet(into)


def drain(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait until the stream ends; an error of the stream is raised. Without
    ``timeout_s`` there is no limit of time."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError("stream did not finish")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


class LateRows(StreamingQueryListener):
    """Counts the rows that streams drop as later than the watermark, over all
    their triggers (a query itself remembers its last 100 only)."""

    def __init__(self):
        self.by_query: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.by_query.setdefault(str(event.runId), 0)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.by_query[str(p.runId)] = self.by_query.get(str(p.runId), 0) + sum(int(op.numRowsDroppedByWatermark) for op in p.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def dropped_late(query: StreamingQuery) -> int:
    """Rows that the recent triggers dropped as later than the watermark: the
    last 100; ``LateRows`` counts all."""
    return sum(int(op["numRowsDroppedByWatermark"])
               for p in query.recentProgress for op in p["stateOperators"])
