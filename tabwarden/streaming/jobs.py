"""Streaming jobs: continuous drift, scoring with dead letters, cooldown state.

Every sink is idempotent per micro-batch: a batch that runs again overwrites its own folder.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from tabwarden import fixed
from tabwarden.functions import sizing
from tabwarden.operators import clean as cleaning
from tabwarden.operators import rules
from tabwarden.operators.contract import Contract
from tabwarden.sources import readers
from tabwarden.streaming import windows


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, rocksdb: bool = False) -> StreamingQuery:
    """Start a query; a query keeps the settings of its start, so the session's store setting is put back."""
    conf = stream.sparkSession.conf
    before = conf.get(_STORE, None)
    if rocksdb:
        conf.set(_STORE, _ROCKSDB)
    try:
        writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        return writer.trigger(availableNow=True).start()
    finally:
        if rocksdb:
            conf.unset(_STORE) if before is None else conf.set(_STORE, before)


def run_to_end(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def window_stats_job(
    stream: DataFrame,
    at: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    size: str,
    slide: str | None,
    watermark: str,
    out: str,
    checkpoint: str,
) -> StreamingQuery:
    """Write the statistics of every closed window once (append mode)."""
    stats = windows.windowed_stats(stream, at, categorical, numeric, size, slide, watermark)
    return start(stats, lambda df, i: df.write.mode("overwrite").parquet(batch_path(out, i)), checkpoint)


def drift_job(
    stream: DataFrame,
    at: str,
    baseline_shares: DataFrame,
    baseline_means: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    size: str,
    slide: str | None,
    watermark: str,
    out: str,
    checkpoint: str,
) -> StreamingQuery:
    """Judge every closed window against a stored baseline.

    Append mode releases all rows of a window together, so a window is judged exactly once.
    The baseline should be a stored table: it is read in every micro-batch.
    """
    stats = windows.windowed_stats(stream, at, categorical, numeric, size, slide, watermark)

    def judge(df: DataFrame, batch_id: int) -> None:
        closed = sizing.cut_lineage(df, "closed-windows")  # read twice below
        windows.drift_against(closed, baseline_shares, baseline_means).write.mode("overwrite").parquet(batch_path(out, batch_id))

    return start(stats, judge, checkpoint)


def window_drift_job(
    stream: DataFrame,
    at: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    size: str,
    slide: str | None,
    step: str,
    watermark: str,
    out: str,
    state: str,
    checkpoint: str,
) -> StreamingQuery:
    """Judge every closed window against the one ``step`` before it, once.

    State is the statistics of the windows that later ones are compared with: those less than ``step``
    older than the last closed one, as a table a micro-batch. A batch that runs again reads the table of
    the batch before it and overwrites its own.
    """
    stats = windows.windowed_stats(stream, at, categorical, numeric, size, slide, watermark)

    def judge(df: DataFrame, batch_id: int) -> None:
        closed = sizing.cut_lineage(df, "closed-windows")
        known = closed.withColumn("_new", F.lit(True))
        if batch_id:
            before = df.sparkSession.read.schema(closed.schema).parquet(batch_path(state, batch_id - 1))
            known = known.unionByName(before.withColumn("_new", F.lit(False)))
        known = sizing.cut_lineage(known, "known-windows")
        verdicts = windows.drift_against_previous(known.drop("_new"), step)
        fresh = known.where("_new").select("window_start").distinct()
        verdicts.join(F.broadcast(fresh), "window_start", "left_semi").write.mode("overwrite").parquet(batch_path(out, batch_id))  # a row a window
        last = known.agg(F.max("window_start") - F.expr(f"INTERVAL {step}")).scalar()
        known.drop("_new").where(F.col("window_start") > last).write.mode("overwrite").parquet(batch_path(state, batch_id))

    return start(stats, judge, checkpoint)


def labelled_predictions(
    labels: DataFrame, predictions: DataFrame, key: Sequence[str], at: str, value: str, interval: str, delay: str
) -> DataFrame:
    """A stream of labels, each with the latest ``value`` of its key in the ``interval`` up to it, or NULL.

    The streams are joined on key and interval; either side is kept until the watermark says that nothing
    can match it any more, and a label comes out once, when its interval is closed. Each of the two may come
    late by ``delay``. A label without a key or without a prediction comes out with NULL and
    ``matched = false``; labels without a time are no events and are left out.
    """
    of_label = list(labels.columns)
    facts = windows.event_time(labels, at).withWatermark(at, delay)
    known = windows.event_time(predictions, at).withWatermark(at, delay)
    known = known.select(*[F.col(k).alias(f"_{k}") for k in key], F.col(at).alias("_at"), F.struct(F.col(value).alias("v")).alias("_v"))
    near = (F.col("_at") <= F.col(at)) & (F.col("_at") >= F.col(at) - F.expr(f"INTERVAL {interval}"))
    for k in key:
        near = near & (F.col(k) == F.col(f"_{k}"))
    joined = facts.join(known, near, "leftOuter")
    latest = joined.groupBy(*of_label).agg(F.max_by("_v", "_at").alias("_v"))
    when = windows.wall_time(F.col(at)) if windows.zone_less(labels, at) else F.col(at)
    return latest.select(*[when.alias(c) if c == at else c for c in of_label], F.col("_v.v").alias(value), F.col("_v").isNotNull().alias("matched"))


def landing_job(
    spark: SparkSession,
    path: str,
    schema: str,
    each: Callable[[DataFrame, DataFrame, int], None],
    checkpoint: str,
    required: Sequence[str] = (),
    max_files: int | None = None,
    corrupt: str | None = None,
    **options,
) -> StreamingQuery:
    """A landing folder of CSV files as a stream, each file by its own header.

    ``each`` gets the rows, the files refused (``file``, ``missing``) and the number of a micro-batch.
    The stream tells which files are new; a micro-batch reads them by ``readers.read_files``.
    """
    new = spark.readStream.option("pathGlobFilter", "*.csv")
    lines = (new.option("maxFilesPerTrigger", max_files) if max_files else new).text(path)

    def handle(df: DataFrame, batch_id: int) -> None:
        files = [r["file"] for r in df.select("file").distinct().collect()]  # a name per file of the micro-batch
        rows, refused = readers.read_files(df.sparkSession, files, schema, required, corrupt, **options)
        each(rows, refused, batch_id)

    return start(lines.select(F.col("_metadata.file_path").alias("file")), handle, checkpoint)


def scoring_job(
    stream: DataFrame,
    contract: Contract,
    spec: cleaning.CleanSpec,
    score: Callable[[DataFrame], DataFrame],
    scored_path: str,
    dead_path: str,
    checkpoint: str,
    allowed_values: bool = False,
) -> StreamingQuery:
    """Validate and score each micro-batch; rejected rows keep their errors."""

    def handle(df: DataFrame, batch_id: int) -> None:
        annotated = sizing.cut_lineage(rules.annotate(cleaning.clean(df, spec, "score"), contract, allowed_values), "annotated")
        score(rules.valid_rows(annotated)).write.mode("overwrite").parquet(batch_path(scored_path, batch_id))
        rules.invalid_rows(annotated).write.mode("overwrite").parquet(batch_path(dead_path, batch_id))

    return start(stream, handle, checkpoint)


class _Cooldown(StatefulProcessor):
    """Holds drift times until the watermark has passed them, then decides in order of time.

    State of a monitor: the last fired time, and the times that wait, by their millisecond. A timer stands
    at each of these, so state is bounded by the watermark's delay.
    """

    def __init__(self, days: int):
        self.pause = days * 86_400_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us bigint")
        self.waiting = handle.getMapState("waiting", "ms bigint", "us array<bigint>")

    def _row(self, key, us: int, action: str) -> Row:
        return Row(monitor=key[0], us=us, action=action)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        held: dict[int, list[int]] = {}
        for row in rows:
            if row["drifted"]:
                held.setdefault(-(-row["us"] // 1000), []).append(row["us"])
            else:
                yield self._row(key, row["us"], "healthy")
        for ms, times in held.items():
            if self.waiting.containsKey((ms,)):
                times = [*self.waiting.getValue((ms,))[0], *times]
            else:
                self.handle.registerTimer(ms)
            self.waiting.updateValue((ms,), (times,))

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        ms = expiredTimerInfo.getExpiryTimeInMs()
        last = self.last.get()[0] if self.last.exists() else None
        for us in sorted(self.waiting.getValue((ms,))[0]):
            cooling = last is not None and us < last + self.pause
            last = last if cooling else us
            yield self._row(key, us, "suppressed" if cooling else "fire")
        self.last.update((last,))
        self.waiting.removeKey((ms,))

    def close(self) -> None:
        pass


def cooldown_actions(verdicts: DataFrame, monitor: str, at: str, drifted: str, delay: str = "1 hour", days: int = fixed.COOLDOWN_DAYS) -> DataFrame:
    """Cooldown on a stream of verdicts, one row per monitor and window, which may come late by ``delay``.

    Healthy verdicts pass through; drift is decided, in order of time, once the watermark has passed it.
    Needs the RocksDB state store: start it with ``append_job(…, rocksdb=True)``.
    """
    timed = windows.event_time(verdicts, at).select(F.col(monitor).cast("string").alias("monitor"), F.col(at).cast("timestamp").alias("at"), F.coalesce(drifted, F.lit(False)).alias("drifted"))
    timed = timed.where("at IS NOT NULL").withWatermark("at", delay).withColumn("us", F.unix_micros("at"))
    processor = _Cooldown(days)
    decided = timed.groupBy("monitor").transformWithState(processor, "monitor string, us bigint, action string", "append", "EventTime")
    return decided.select(F.col("monitor").alias(monitor), F.timestamp_micros("us").alias(at), "action")


def once(stream: DataFrame, key: Sequence[str], at: str, delay: str) -> DataFrame:
    """Rows of a stream by their first delivery, however often and in whichever micro-batch they come again.

    A key is remembered until the watermark has passed it by ``delay``; a copy that comes after that is late.
    """
    timed = windows.event_time(stream, at).withWatermark(at, delay).dropDuplicatesWithinWatermark(list(key))
    return timed.withColumn(at, windows.wall_time(F.col(at))) if windows.zone_less(stream, at) else timed


def append_job(stream: DataFrame, out: str, checkpoint: str, rocksdb: bool = False) -> StreamingQuery:
    return start(stream, lambda df, i: df.write.mode("overwrite").parquet(batch_path(out, i)), checkpoint, rocksdb)


def folders(df: DataFrame, name: str) -> tuple[str, str]:
    """Fresh output and checkpoint folders under the shared folder."""
    base = sizing.run_dir(df.sparkSession, name)
    return f"{base}/out", f"{base}/checkpoint"
