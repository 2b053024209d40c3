"""What the operators share: byte-level words, Arrow batches, tables that cut lineage."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termtide.session import scratch_dir

# Words of the contracts: A-Z lower-cased, then runs of 0-9, a-z and everything that is not
# ASCII. On UTF-8 bytes that is a translation to spaces and a split.
_WORD_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def spaced(raw: bytes | None) -> bytes:
    """The words of a text, each with a space before and after; a lone space if none."""
    words = (raw or b"").translate(_WORD_TABLE).split()
    return b" " + b" ".join(words) + b" " if words else b" "


def sha256_hex(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


# Rows and bytes per Arrow batch: texts are long, and both sides hold a batch or two of each task.
ARROW_ROWS = 2_000
ARROW_BYTES = 8 << 20


def use_text_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


_held: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], object]):
    """What `make` builds, kept for later tasks of this Python worker that ask for the same key.

    A worker serves all operators of a job in turn and keeps one such object, so that the tables
    of one operator do not lie beside those of the next.
    """
    if key not in _held:
        let_go()
        _held[key] = make()
    return _held[key]


def let_go() -> None:
    """Drop what earlier tasks of this Python worker kept, and return free memory to the system."""
    _held.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # absent outside glibc
    if trim:
        trim(0)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its exact name, whatever signs that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no column a stage adds can take the name of one."""
    return F.struct(*[column(name) for name in df.columns])


def carried(df: DataFrame, text_col: str) -> DataFrame:
    """The text as `text` and all other columns as the struct `row`, for a pass through Python."""
    others = [column(name) for name in df.columns if name != text_col]
    row = F.struct(*others) if others else F.struct(F.lit(None).cast("int").alias("none"))
    return df.select(row.alias("row"), column(text_col).alias("text"))


def restored(names: list[str], text_col: str, text: str = "text") -> list[Column]:
    """The columns that `carried` has put away, in their order."""
    return [
        (F.col(text) if name == text_col else F.col("row").getField(name)).alias(name)
        for name in names
    ]


# Keys with more than this share of all rows are joined by broadcast: at most so many exist.
HOT_KEYS = 10_000
LEAST_HOT = 512


def join_spread(
    rows: DataFrame,
    table: DataFrame,
    on: str,
    total: int,
    count: str,
    hot_keys: int = HOT_KEYS,
    least_hot: int = LEAST_HOT,
) -> DataFrame:
    """Inner join with a table of one row per key that tells in `count` how many rows have it.

    Of `total` rows, keys with more than a part of `hot_keys` are at most `hot_keys` many; they
    are joined by broadcast, so no task gets all rows of one. The others are joined by shuffle.
    """
    limit = max(total // hot_keys, least_hot)
    hot = table.filter(F.col(count) > limit)
    if not hot.head(1):
        return rows.join(table, on)
    apart = rows.join(F.broadcast(hot.select(on)), on, "left_anti")
    rest = apart.join(table.filter(F.col(count) <= limit), on)
    return rest.unionByName(rows.join(F.broadcast(hot), on))


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write a table under the shared folder and read it back: lineage ends here.

    A lost executor costs the tasks it ran, not the stages before this table.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_and_bytes(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id (as `id`) and the text's UTF-8 bytes (as `raw`); other columns are not read."""
    use_text_batches(df.sparkSession)
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("raw"))


def columns_of(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(name).to_pylist() for name in names]


def batch_of(schema: pa.Schema, columns: Iterable[list]) -> pa.RecordBatch:
    arrays = [pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def small_batches(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `rows`, so that what a batch becomes stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
