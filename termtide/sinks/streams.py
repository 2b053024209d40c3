"""Stream writers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from time import monotonic, sleep

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.utils import AnalysisException

from termtide.operators.windows import (
    BLOCK_PANES,
    block_stride,
    block_windows,
    pane_count,
    pane_counts,
    place_in_blocks,
    seconds,
)
from termtide.session import SPREAD_TASKS_PER_CORE, spread_in_time
from termtide.sinks.ledger import EVERY, MOST_SHARED, Kept, Ledger

COUNTS, WINDOWS, RATES = "counts", "windows", "rates"
RATES_KEPT = Kept(("number", "read_at", "seconds"), "last")
# Markers of snapshots lie in so many places.
MARKERS = 16
# What a task counts words of where it holds whole blocks of time, and the most that a block may
# have to be counted by one task.
BLOCK_TASK_BYTES = 8 << 20
BLOCK_MOST_BYTES = 32 << 20


# Blocks near each other share a task in runs of so much text, where they are to be written by day.
BLOCK_RUN_BYTES = BLOCK_TASK_BYTES // 4

# `(*keys, time)` of rows, and the columns it is told to keep.
Tokens = Callable[[DataFrame, Sequence[str]], DataFrame]


def _timed(writer: DataStreamWriter, every: str | None, bounded: bool) -> DataStreamWriter:
    if bounded:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def to_console(
    result: DataFrame,
    checkpoint: str | None = None,
    rows: int = 20,
    mode: str = "complete",
    every: str | None = None,
    bounded: bool = False,
) -> StreamingQuery:
    """Print the first rows of each result, untruncated.

    The console sink brings a whole result to the driver before it prints a part, so results are
    limited to the printed rows on the executors, in every mode.
    """

    def show(batch: DataFrame, batch_id: int) -> None:
        # All of the batch is computed, since its state is saved in passing.
        batch = batch.persist()
        print(f"Batch: {batch_id}, {batch.count()} rows")
        batch.limit(rows).show(rows, truncate=False)
        batch.unpersist()

    if mode == "complete":
        writer = result.limit(rows).writeStream.format("console")
        writer = writer.option("truncate", False).option("numRows", rows)
    else:
        writer = result.writeStream.foreachBatch(show)
    writer = writer.outputMode(mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return _timed(writer, every, bounded).start()


def to_parquet(
    result: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    bounded: bool = False,
    by_day: bool = False,
) -> StreamingQuery:
    """Append finished rows to a folder, exactly once through the sink's commit log.

    `by_day` puts windows in a folder for each day on which they start, so that readers of some
    days leave out the others.
    """
    if by_day:
        result = result.withColumn("day", F.to_date("window.start"))
    writer = result.writeStream.format("parquet").outputMode("append")
    if by_day:
        writer = writer.partitionBy("day")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return _timed(writer, every, bounded).start()


def _mark_done(spark: SparkSession, path: str, batch_id: int, seen: int | None = None) -> None:
    """A marker beside the results, written once a batch is complete.

    Markers take the places of older ones, so their number does not grow. `seen` is the newest
    event time so far in microseconds, where the next batch needs it.
    """
    marker = spark.range(batch_id, batch_id + 1, 1, 1)
    marker = marker.withColumn("seen", F.lit(seen).cast("bigint"))
    marker.write.mode("overwrite").parquet(f"{path}.done/marker={batch_id % MARKERS}")


def _done(spark: SparkSession, path: str) -> DataFrame:
    reader = spark.read.schema("id bigint, seen bigint").option("ignoreMissingFiles", True)
    return reader.parquet(f"{path}.done").select(F.col("id").alias("batch"), "seen")


def _last_done(spark: SparkSession, path: str) -> Row | None:
    """The marker of the newest complete batch."""
    try:
        return _done(spark, path).orderBy(F.desc("batch")).first()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def _drop_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def to_snapshots(
    result: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    bounded: bool = False,
    finish: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    keep: int = 3,
    tokens: Tokens | None = None,
    blocks: tuple[str, str] | None = None,
    keys: Sequence[str] = ("word",),
    time: str = "event_time",
) -> StreamingQuery:
    """Write the whole current result of a complete-mode query at each trigger.

    `finish` may derive the final table from the state, such as windows from panes.
    Executors write one folder per batch. A batch repeated after a failure overwrites its
    own folder, so nothing counts twice. The last `keep` snapshots stay for readers.

    For windowed counts over a large vocabulary `result` may be the rows to be counted instead, with
    their `tokens` and `blocks`, the size and slide of the windows: no state store holds the counts.
    Each batch is counted as a table and added to the snapshot before it. Snapshots are then rows of
    `block_count`, which readers slide, in place of several times as many windows.
    """
    if keep < 2:
        raise ValueError("keep at least 2, one to read while the next is written")

    def current(batch: DataFrame, batch_id: int) -> DataFrame | None:
        """The blocks of all batches, or None where the batch has been added already."""
        last = _last_done(batch.sparkSession, path)
        if last and last.batch >= batch_id:
            return None
        _, counted = _count_in_blocks(batch, tokens, time, keys, blocks)
        if not last:
            return counted(batch)
        before = batch.sparkSession.read.parquet(f"{path}/batch={last.batch}")
        return _added_blocks(before, batch, counted, time, keys, blocks)

    def save(batch: DataFrame, batch_id: int) -> None:
        made = current(batch, batch_id) if tokens else batch
        if made is None:
            return
        finish(made).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        _mark_done(batch.sparkSession, path, batch_id)
        if batch_id >= keep:
            _drop_folder(batch.sparkSession, f"{path}/batch={batch_id - keep}")

    writer = result.writeStream.outputMode("append" if tokens else "complete").foreachBatch(save)
    writer = writer.option("checkpointLocation", checkpoint)
    return _timed(writer, every, bounded).start()


def _added_blocks(
    before: DataFrame,
    batch: DataFrame,
    counted: Callable[..., DataFrame],
    time: str,
    keys: Sequence[str],
    windows: tuple[str, str],
) -> DataFrame:
    """Earlier blocks and those of a batch. Only blocks that both have are shuffled, if they are few."""
    start = F.unix_micros("window.start")
    own = place_in_blocks(batch, time, *windows).select(start.alias("start")).distinct()
    both = before.select(start.alias("start")).distinct().join(own, "start").limit(MOST_SHARED + 1)
    both = [row.start for row in both.collect()]

    def added(rows: DataFrame) -> DataFrame:
        return rows.groupBy("window", *keys).agg(*[F.sum(c).alias(c) for c in pane_counts()])

    if len(both) > MOST_SHARED:
        return added(before.unionByName(counted(batch)))
    if not both:
        return before.unionByName(counted(batch))
    shared = start.isin(both)
    apart = before.where(~shared).unionByName(counted(batch, ~shared))
    return apart.unionByName(added(before.where(shared).unionByName(counted(batch, shared))))


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete snapshot; only its folder is read."""
    newest = _done(spark, path).agg(F.max("batch")).first()[0]
    return spark.read.parquet(path).where(F.col("batch") == newest).drop("batch")


def to_changes(
    result: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    every: str | None = None,
    bounded: bool = False,
    merge_every: int = EVERY,
) -> StreamingQuery:
    """Keep the counts of an update-mode query, writing only what changed at each trigger.

    For counts over a large vocabulary, where writing the whole result each time costs more than
    the new rows do. Every `merge_every` batches the changes are merged into a base.
    """
    ledger = Ledger(result.sparkSession, path, {COUNTS: Kept(tuple(keys), "last")}, merge_every)
    writer = result.writeStream.outputMode("update")
    writer = writer.foreachBatch(lambda rows, batch: ledger.write(batch, {COUNTS: rows}))
    return _timed(writer.option("checkpointLocation", checkpoint), every, bounded).start()


def read_changes(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The current count of each key: the one its last complete change wrote."""
    return Ledger(spark, path, {COUNTS: Kept(tuple(keys), "last")}).read(COUNTS)


def to_windows(
    result: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    delay: str,
    every: str | None = None,
    bounded: bool = False,
    merge_every: int = EVERY,
    then: Callable[[DataFrame], None] | None = None,
    blocks: tuple[str, str] | None = None,
    tokens: Tokens | None = None,
    time: str = "event_time",
) -> StreamingQuery:
    """Keep windowed counts of an update-mode query whose watermark lags by `delay`.

    Spark drops the state of a window when the watermark passes it; its rows then move to a table
    partitioned by day and are not written again. `then` gets the whole table after each batch.
    `blocks` is given where the result is a `block_count`: the size and slide of its windows.

    For a large vocabulary `result` may be the rows to be counted instead, with `blocks` and the
    `tokens` of rows: no state store holds their counts. Each batch is counted as a table, and the
    ledger adds up the blocks that are open. Blocks that ended `delay` before the newest time seen
    are closed, and later rows for them are dropped, as by the watermark. Blocks that start and
    close within a batch go to the table by day at once.
    """
    ledger = window_ledger(result.sparkSession, path, keys, delay, merge_every, blocks, tokens is not None)
    kept = ledger.tables[WINDOWS]

    def save(rows: DataFrame, batch: int) -> None:
        if tokens:
            before = ledger.last_before(batch)
            if not before:
                return
            newest, counted = _count_in_blocks(rows, tokens, time, keys, blocks, in_runs=True)
            on_time, whole = _wanted_blocks(kept, before.seen, newest)
            closing = {} if whole is None else {WINDOWS: counted(rows, whole)}
            ledger.write(batch, {WINDOWS: counted(rows, on_time)}, seen=newest, closing=closing)
        else:
            ledger.write(batch, {WINDOWS: rows})
        if then:
            then(ledger.read(WINDOWS))

    writer = result.writeStream.outputMode("append" if tokens else "update").foreachBatch(save)
    return _timed(writer.option("checkpointLocation", checkpoint), every, bounded).start()


def _wanted_blocks(kept: Kept, before: int | None, newest: int | None) -> tuple[Column, Column | None]:
    """Which blocks of a batch to add to open ones, and which of them no other batch can have.

    The newest time before the batch, and in it, tell. The second is None where no block can be so.
    """
    if newest is None:
        return F.lit(True), None
    on_time = F.lit(True) if before is None else ~kept.ended(before)
    watermark = newest - seconds(kept.delay) * 1_000_000
    if before is not None and watermark - before <= BLOCK_PANES * seconds(kept.blocks[1]) * 1_000_000:
        return on_time, None
    whole = kept.ended(newest)
    if before is not None:
        whole &= F.unix_micros("window.start") > before
    return on_time & ~whole, whole


def window_ledger(
    spark: SparkSession,
    path: str,
    keys: Sequence[str],
    delay: str,
    merge_every: int = EVERY,
    blocks: tuple[str, str] | None = None,
    counted: bool = False,
) -> Ledger:
    """The ledger behind `to_windows`, for reading; `counted` where that got `tokens`."""
    how = "sum" if counted else "last"
    kept = Kept(("window", *keys), how, delay, blocks=blocks, final=counted)
    return Ledger(spark, path, {WINDOWS: kept}, merge_every)


def _count_in_blocks(
    batch: DataFrame,
    tokens: Tokens,
    time: str,
    keys: Sequence[str],
    windows: tuple[str, str],
    in_runs: bool = False,
) -> tuple[int | None, Callable[..., DataFrame]]:
    """The newest time of a batch in microseconds, and a function that counts rows of it in blocks.

    Blocks that fit a task are counted where their texts meet, without a shuffle of counts; larger
    ones are dealt over several tasks and their counts shuffled. `in_runs` gives a task runs of
    blocks near each other, for results that are written by day. The function may be given a
    condition on the blocks, `window`, to be counted.
    """
    size, slide = windows
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in batch.dtypes if kind == "string"]
    sizes = place_in_blocks(batch, time, size, slide).groupBy("window")
    sizes = sizes.agg(F.max(time).alias("newest"), F.sum(sum(texts, F.lit(1).cast("bigint"))).alias("bytes")).persist()
    found = sizes.agg(F.unix_micros(F.max("newest")), F.sum("bytes"), F.count("*")).first()
    newest, volume, number = found[0], found[1] or 0, max(found[2], 1)
    block = F.unix_micros("window.start")
    full = sizes.where(F.col("bytes") > BLOCK_MOST_BYTES).agg(F.collect_list(block)).first()[0]
    sizes.unpersist()
    tasks = batch.sparkSession.sparkContext.defaultParallelism * SPREAD_TASKS_PER_CORE
    tasks = max(tasks, volume // BLOCK_TASK_BYTES)
    together = max(1, number * BLOCK_RUN_BYTES // max(volume, 1)) if in_runs else 1
    run = F.call_function("div", block, F.lit(together * block_stride(size, slide) * 1_000_000))

    def counted(rows: DataFrame, wanted: Column | None = None) -> DataFrame:
        placed = place_in_blocks(rows, time, size, slide)
        if wanted is not None:
            placed = placed.where(wanted)
        large = block.isin(full)
        small = placed.where(~large).withColumn("_run", run).repartition(tasks, "_run")
        # Runs are dealt whole, so counts of a run do not leave their task.
        small = pane_count(tokens(small, ["window", "_run"]), time, ["_run", *keys], slide).drop("_run")
        if not full:
            return small
        dealt = spread_in_time(placed.where(large), time, volume)
        return small.unionByName(pane_count(tokens(dealt, ["window"]), time, keys, slide))

    return newest, counted


def to_ended_windows(
    stream: DataFrame,
    tokens: Tokens,
    path: str,
    checkpoint: str,
    time: str,
    keys: Sequence[str],
    windows: tuple[str, str],
    delay: str,
    every: str | None = None,
    bounded: bool = False,
) -> StreamingQuery:
    """Append windowed counts once they end `delay` before the newest time seen, as append mode does.

    For counts over a large vocabulary: no state store holds them. `tokens` gives `(*keys, time)` of
    rows and the columns it is told to keep; they are counted in sliding `windows`, size and slide.
    Each batch is counted as a table and writes all of its windows once, `closed` telling those
    that ended. The next batch reads the open ones from there and counts on, so only windows that
    had started before it are merged. Rows for windows that were closed before their batch are late
    and dropped. The markers say which batches are complete; a batch repeated after a failure
    overwrites its own folder.
    """
    size, slide = windows

    def ended(seen: int) -> Column:
        watermark = F.timestamp_millis(F.lit(seen // 1_000 - seconds(delay) * 1_000))
        return F.col("window.end") <= watermark

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = _last_done(spark, path)
        if last and last.batch >= batch_id:
            return
        newest, blocks = _count_in_blocks(batch, tokens, time, keys, windows)

        def counted(rows: DataFrame) -> DataFrame:
            return block_windows(blocks(rows), keys, size, slide)

        if not last or last.seen is None:
            seen, counts = newest, counted(batch)
        else:
            seen = last.seen if newest is None else max(newest, last.seen)
            # No window that is open from earlier batches starts later than this.
            border = F.timestamp_micros(F.lit(last.seen))
            started = F.col("window.start") <= border
            reach = F.timestamp_micros(F.lit(last.seen + seconds(size) * 1_000_000))
            fresh = counted(batch.where(F.col(time) > border)).where(~started)
            again = counted(batch.where(F.col(time) < reach)).where(started & ~ended(last.seen))
            before = spark.read.parquet(f"{path}/batch={last.batch}").where(~F.col("closed"))
            again = again.unionByName(before.drop("closed"))
            again = again.groupBy("window", *keys).agg(F.sum("count").alias("count"))
            counts = fresh.unionByName(again)
        closed = F.lit(False) if seen is None else ended(seen)
        counts.withColumn("closed", closed).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        _mark_done(spark, path, batch_id, seen)

    writer = stream.writeStream.outputMode("append").foreachBatch(save)
    return _timed(writer.option("checkpointLocation", checkpoint), every, bounded).start()


def read_ended_windows(spark: SparkSession, path: str) -> DataFrame:
    """The windows that ended by the newest complete batch, each one once."""
    last = _last_done(spark, path)
    if not last:
        raise ValueError(f"no batch is complete under {path}")
    saved = spark.read.parquet(path).where((F.col("batch") <= last.batch) & F.col("closed"))
    return saved.drop("batch", "closed")


def to_tables(
    stream: DataFrame,
    ledger: Ledger,
    results: Mapping[str, Callable[[DataFrame], DataFrame]],
    checkpoint: str,
    time: str | None = None,
    every: str | None = None,
    bounded: bool = False,
    then: Callable[[Ledger], None] | None = None,
) -> StreamingQuery:
    """Write several results of one stream, each batch read and parsed once.

    Each result is a function from a batch's rows to its own counts; the ledger adds them up, so
    no state is kept besides its tables. The batch is stored while they are computed, and one
    mark completes all of them. `time` names the event time that watermarks follow. The table
    `RATES`, if the ledger has it, gets a row for each batch. `then` is called after it.
    """
    read_at = [monotonic()]

    def save(rows: DataFrame, batch: int) -> None:
        rows = rows.persist()
        newest = F.unix_micros(F.max(time)) if time else F.lit(None)
        size, seen = rows.agg(F.count("*"), newest).first()
        made = {name: result(rows) for name, result in results.items()}
        if RATES in ledger.tables:
            read_at.append(monotonic())
            made[RATES] = _rate(rows.sparkSession, batch, size, read_at[1] - read_at.pop(0))
        try:
            ledger.write(batch, made, size, seen)
        finally:
            rows.unpersist()
        if then:
            then(ledger)

    writer = stream.writeStream.outputMode("append").foreachBatch(save)
    return _timed(writer.option("checkpointLocation", checkpoint), every, bounded).start()


def _rate(spark: SparkSession, batch: int, rows: int, seconds: float) -> DataFrame:
    """A row for the rate table: rows of a batch, and the seconds since the one before was read.

    For the first batch of a run they count from the start of the query.
    """
    made = spark.range(1).select(
        F.lit(batch).cast("bigint").alias("number"),
        F.current_timestamp().alias("read_at"),
        F.lit(float(seconds)).alias("seconds"),
        F.lit(rows).cast("bigint").alias("count"),
    )
    return made.coalesce(1)


def await_idle(query: StreamingQuery, idle_seconds: float = 5.0, poll_seconds: float = 0.5) -> None:
    """Stop a query once no rows have arrived for a while, as a bounded read of a topic."""
    quiet_since = monotonic()
    seen = None
    while query.isActive and monotonic() - quiet_since < idle_seconds:
        progress = query.lastProgress
        batch = progress["batchId"] if progress else None
        busy = query.status["isTriggerActive"] and query.status["isDataAvailable"]
        if busy or (batch != seen and progress["numInputRows"] > 0):
            quiet_since = monotonic()
        seen = batch
        sleep(poll_seconds)
    if query.exception():
        raise query.exception()
    query.stop()
