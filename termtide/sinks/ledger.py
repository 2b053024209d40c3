"""Tables that a stream writes batch by batch and whose folders stay few.

Each batch leaves its own rows as changes. Every few batches the changes so far are merged into a
new base, and rows of windows that can no longer change leave the base for a table partitioned by
day, where they are never written again. A mark, written last, names the batch and the base that
belong together; what no mark names does not count. So all tables of a batch become visible at
once, and a batch that is repeated after a failure counts once.

Changes, bases and marks lie in numbered places that are used over and over, so the number of
their folders does not grow with the number of batches, and nothing has to be deleted.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from termtide.operators.windows import BLOCK_PANES, block_windows, pane_counts, seconds

EVERY = 8
# The base in use, the one before for its readers, and the one being written.
BASES = 3
# Where more blocks than this are in several parts, all rows are merged.
MOST_SHARED = 1_000
MARK = (
    "batch bigint, upto bigint, merges bigint, total bigint, seen bigint, seen_before bigint, "
    "tables array<string>, closed array<string>"
)


@dataclass(frozen=True)
class Kept:
    """How rows of equal keys become one.

    `how="sum"` adds up the partial counts that batches bring; `how="last"` keeps the count that
    the last batch brought, as an update-mode query gives it. With `delay`, a duration, `window`
    is one of the keys: windows that ended that long before the newest time seen are closed.
    Counts for a window that was closed before their batch go to the table `<name>_late` where
    `aside` is set, else they are added as well; for `how="last"` Spark has dropped them.
    With `blocks`, the size and slide of sliding windows, rows are those of `block_count`, of which
    `window` is a whole block; they become windows when the table is read.
    With `final` batches bring a row of each key at most, and none for blocks that were closed by
    the newest time before them. So closed rows are whole, and only blocks that several batches
    share are merged.
    """

    keys: tuple[str, ...]
    how: str = "sum"
    delay: str | None = None
    aside: bool = False
    blocks: tuple[str, str] | None = None
    final: bool = False

    def __post_init__(self) -> None:
        if self.final and not (self.blocks and self.delay and self.how == "sum"):
            raise ValueError("only sums of blocks that close can be final")
        if self.aside and self.blocks:
            raise ValueError("blocks end later than their windows, so late rows cannot be told")

    @property
    def counts(self) -> list[str]:
        return pane_counts() if self.blocks else ["count"]

    def merge(self, rows: DataFrame) -> DataFrame:
        if self.how == "sum":
            counts = [F.sum(name).alias(name) for name in self.counts]
        else:
            counts = [F.max_by(name, "batch").alias(name) for name in self.counts]
        return rows.groupBy(*self.keys).agg(*counts, F.max("batch").alias("batch"))

    def result(self, merged: DataFrame) -> DataFrame:
        """What readers get of merged rows, `(*keys, count)`."""
        if self.blocks:
            return block_windows(merged, [k for k in self.keys if k != "window"], *self.blocks)
        return merged.drop("batch")

    def reach(self) -> datetime.timedelta:
        """How long before a day a row may start that holds windows of this day."""
        length = BLOCK_PANES * seconds(self.blocks[1]) if self.blocks else 0
        return datetime.timedelta(days=-(-length // 86_400))

    def ended(self, seen: int) -> Column:
        """Windows that end before the watermark for a newest time, in microseconds."""
        return F.col("window.end") <= F.timestamp_micros(F.lit(seen)) - F.expr(f"interval {self.delay}")


class Ledger:
    """The tables under a path. `every` is the number of batches between merges."""

    def __init__(
        self, spark: SparkSession, path: str, tables: Mapping[str, Kept], every: int = EVERY
    ):
        if every < 1:
            raise ValueError("merge after one batch at least")
        self.spark, self.path, self.every = spark, path.rstrip("/"), every
        self.tables = dict(tables)
        for name, kept in tables.items():
            if kept.aside:
                self.tables[f"{name}_late"] = Kept(kept.keys)
        # Twice as many as a mark names, so that readers of an earlier mark find their places.
        self.places = 2 * every + 2

    def _changes(self, name: str, batch: int) -> str:
        return f"{self.path}/{name}/changes/place={batch % self.places}"

    def _base(self, name: str, merges: int) -> str:
        return f"{self.path}/{name}/base/place={merges % BASES}"

    def marks(self) -> list[Row]:
        """The newest marks, oldest first; none before the first batch is complete."""
        reader = self.spark.read.schema(MARK).option("ignoreMissingFiles", True)
        try:
            return sorted(reader.parquet(f"{self.path}/marks").collect(), key=lambda m: m.batch)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error):
                return []
            raise

    def last_before(self, batch: int) -> Row | None:
        """The mark that a batch goes on from, or None where the batch has a mark itself."""
        marks = self.marks()
        if any(mark.batch == batch for mark in marks):
            return None
        none = Row(batch=-1, upto=-1, merges=0, total=0, seen=None, seen_before=None, tables=[], closed=[])
        return max((m for m in marks if m.batch < batch), key=lambda m: m.batch, default=none)

    def write(
        self,
        batch: int,
        results: Mapping[str, DataFrame],
        rows: int = 0,
        seen: int | None = None,
        closing: Mapping[str, DataFrame] | None = None,
    ) -> None:
        """The results of a batch, by table.

        `seen` is the newest event time among its `rows` in microseconds; where it is not given,
        the newest start of a window takes its place. A batch that has a mark is left as it is.
        `closing` are further rows of `final` tables, of blocks that are in no other batch and
        closed by `seen`.
        """
        mark = self.last_before(batch)
        if not mark:
            return
        for name, result in results.items():
            kept = self.tables[name]
            if kept.aside:
                # Spark judges a batch by the watermark of the batch before; so does this.
                late = F.lit(False) if mark.seen_before is None else kept.ended(mark.seen_before)
                result = result.persist()
                self._put(result.where(late), f"{name}_late", batch)
                self._put(result.where(~late), name, batch)
                result.unpersist()
            else:
                self._put(result, name, batch)
        if seen is None:
            seen = self._newest_start(batch, [name for name in results if self.tables[name].delay])
        newest = max((s for s in (seen, mark.seen) if s is not None), default=None)
        late_tables = [f"{name}_late" for name in results if self.tables[name].aside]
        tables = sorted({*mark.tables, *results, *late_tables})
        upto, merges, closed = mark.upto, mark.merges, set(mark.closed)
        for name, result in (closing or {}).items():
            self._close(name, result.withColumn("batch", F.lit(batch).cast("bigint")), batch, "own")
            closed.add(name)
        if batch - upto >= self.every:
            merges += 1
            for name in tables:
                if self._merge(name, mark, batch, merges, newest):
                    closed.add(name)
            upto = batch
        row = (batch, upto, merges, mark.total + rows, newest, mark.seen, tables, sorted(closed))
        marked = self.spark.createDataFrame([row], MARK).coalesce(1)
        marked.write.mode("overwrite").parquet(f"{self.path}/marks/place={batch % self.places}")

    def _put(self, rows: DataFrame, name: str, batch: int) -> None:
        kept = self.tables[name]
        rows = rows.select(*kept.keys, *kept.counts, F.lit(batch).cast("bigint").alias("batch"))
        rows.write.mode("overwrite").parquet(self._changes(name, batch))

    def _newest_start(self, batch: int, names: Sequence[str]) -> int | None:
        newest = F.unix_micros(F.max("window.start"))
        found = [self.spark.read.parquet(self._changes(n, batch)).select(newest).first()[0] for n in names]
        return max((s for s in found if s is not None), default=None)

    def _parts(self, name: str, mark: Row, batch: int) -> list[str]:
        """The base a mark names and the changes after it up to a batch."""
        parts = [self._changes(name, b) for b in range(mark.upto + 1, batch + 1)]
        if mark.upto >= 0:
            parts.append(self._base(name, mark.merges))
        return parts

    def _rows(self, name: str, mark: Row, batch: int) -> DataFrame:
        """The rows of these parts, merged only where the table is `final`."""
        kept, parts = self.tables[name], self._parts(name, mark, batch)
        rows = self.spark.read.parquet(*parts)
        return self._merge_shared(kept, rows, parts) if kept.final else rows

    def _merge_shared(self, kept: Kept, rows: DataFrame, parts: Sequence[str]) -> DataFrame:
        """One row for each key, given that no part has two.

        Rows of blocks that are in one part alone stay as they are, so nothing of them is shuffled.
        """
        start = F.unix_micros("window.start")
        places = [self.spark.read.schema(rows.schema).parquet(part).select(start.alias("start")).distinct() for part in parts]
        places = reduce(DataFrame.unionAll, places).groupBy("start").agg(F.count("*").alias("parts"))
        shared = [r.start for r in places.where("parts > 1").select("start").limit(MOST_SHARED + 1).collect()]
        if not shared:
            return rows
        if len(shared) > MOST_SHARED:
            return kept.merge(rows)
        merged = kept.merge(rows.where(start.isin(shared)))
        return rows.where(~start.isin(shared)).unionByName(merged)

    def _close(self, name: str, rows: DataFrame, batch: int, origin: str) -> None:
        """Rows that no later batch changes, in the table by day."""
        kept, path = self.tables[name], f"{self.path}/{name}/closed/upto={batch}"
        rows = rows.select(*kept.keys, *kept.counts, "batch", F.to_date("window.start").alias("day"))
        if kept.final:
            # They lie in runs of blocks already, and are many.
            path = f"{path}/origin={origin}"
        else:
            rows = rows.hint("rebalance", "day")
        rows.write.mode("overwrite").partitionBy("day").parquet(path)

    def _merge(self, name: str, mark: Row, batch: int, merges: int, newest: int | None) -> bool:
        """A new base from the last one and the changes since, without what is closed by now.

        True if closed windows were looked for, so that their table exists.
        """
        kept = self.tables[name]
        rows = self._rows(name, mark, batch)
        merged = rows if kept.final else kept.merge(rows)
        # No later batch is judged by an earlier watermark than this.
        seen = newest if kept.final else mark.seen
        if not kept.delay or seen is None:
            merged.write.mode("overwrite").parquet(self._base(name, merges))
            return False
        ended = kept.ended(seen)
        if not kept.final:
            merged = merged.persist()
        merged.where(~ended).write.mode("overwrite").parquet(self._base(name, merges))
        self._close(name, merged.where(ended), batch, "merged")
        merged.unpersist()
        return True

    def read(
        self, name: str, since: datetime.date | None = None, until: datetime.date | None = None
    ) -> DataFrame:
        """The table as of the newest mark, one row for each key: `(*keys, count)`.

        `since` and `until`, both included, keep windows that start on such days; only these days
        of the closed windows are read.
        """
        marks = self.marks()
        if not marks:
            raise ValueError(f"no batch is complete under {self.path}")
        mark, kept = marks[-1], self.tables[name]
        open_rows = self._rows(name, mark, mark.batch)
        rows = open_rows
        days = since, until
        if since:
            since = since - kept.reach()
        if since or until:
            rows = _within(rows, F.to_date("window.start"), since, until)
        if name in mark.closed:
            schema = T.StructType([*open_rows.schema.fields])
            schema = schema.add("upto", T.LongType()).add("day", T.DateType())
            if kept.final:
                schema = schema.add("origin", T.StringType())
            closed = self.spark.read.schema(schema).parquet(f"{self.path}/{name}/closed")
            upto = mark.batch if kept.final else mark.upto
            closed = _within(closed.where(F.col("upto") <= upto), F.col("day"), since, until)
            rows = rows.unionByName(closed.select(*rows.columns))
        found = kept.result(rows if kept.final else kept.merge(rows))
        return _within(found, F.to_date("window.start"), *days) if kept.blocks else found


def _within(
    rows: DataFrame, day: Column, since: datetime.date | None, until: datetime.date | None
) -> DataFrame:
    if since:
        rows = rows.where(day >= F.lit(since))
    return rows.where(day <= F.lit(until)) if until else rows
