"""Batch readers. Schemas are explicit or all-text; nothing is inferred from values."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from termtide.functions.text import base_name, strip

# A record in strict CSV: a field that starts with a quote ends with one and doubles those
# inside; any other stays on its line. Possessive, so that long fields cannot overflow.
_FIELD = r'(?:"(?:[^"]|"")*+"|[^",\r\n][^,\r\n]*+|)'
STRICT_RECORD = rf"(?s)\A{_FIELD}(?:,{_FIELD})*+\z"

# Lines of a file that are put together by one task at a time.
LINES_TOGETHER = 1_024

BENCH_SCHEMA = T.StructType(
    [
        T.StructField("size", T.LongType()),
        T.StructField("workers", T.IntegerType()),
        T.StructField("time_s", T.DoubleType()),
        T.StructField("throughput_rps", T.DoubleType()),
        T.StructField("latency_s", T.DoubleType()),
    ]
)
SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("total_records", T.LongType()),
        T.StructField("num_processes", T.IntegerType()),
    ]
)


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV with a header as an all-text table; doubled quotes and line breaks are kept.

    A file that may hold line breaks inside fields is not split here, so each becomes one
    task. For files larger than a task should read use `read_csv_split`, or pass
    `multi_line=False` where fields hold no line breaks.
    """
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_csv_split(spark: SparkSession, path: str) -> DataFrame:
    """`read_csv` for files of any size: they are split, and records put together again.

    A line starts a record if an even number of quotes stands before it in its file. The
    splits of Spark's reader are cut into runs of `LINES_TOGETHER` lines, called splits below.
    Quotes are summed per split, and the sums, one row per split, are added up along
    each file. Text is shuffled once, split by split; only the lines of a record that
    crosses into the next split travel further.

    Only strict CSV can be put together like this, so every record is checked: a stray or
    open quote, a bare carriage return as line end or a blank line before the header raises
    an error, and `read_csv` has to read such a file.
    """
    columns = read_csv(spark, path).columns
    split_key = ["file", "split"]
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
            "value",
            quotes.alias("quotes"),
        )
    )
    run = F.call_function("div", F.col("seq"), F.lit(LINES_TOGETHER))
    lines = lines.withColumn("split", F.struct("block", run.alias("run"))).drop("block")
    earlier = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    opened = lines.groupBy(*split_key).agg(F.sum("quotes").alias("quotes"))
    opened = opened.select(
        *split_key,
        F.coalesce(F.sum("quotes").over(earlier), F.lit(0)).alias("opened"),
        (F.count("*").over(earlier) == 0).alias("first"),
    )

    in_split = W.partitionBy(*split_key).orderBy("seq")
    before = F.coalesce(
        F.sum("quotes").over(in_split.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    starts = ((F.col("opened") + F.col("before")) % 2 == 0).cast("int")
    # Pieces of record 0 continue a record of an earlier split.
    pieces = (
        lines.withColumn("before", before)
        .join(opened, split_key)
        .withColumn("starts", starts)
        .withColumn("record", F.sum("starts").over(in_split.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy(*split_key, "record", "first")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "value"))).alias("parts"))
        .select(*split_key, "record", "first", F.concat_ws("\n", "parts.value").alias("text"))
    )

    last = pieces.groupBy(*split_key).agg(
        F.max("record").alias("last"),
        F.max(F.when(F.col("record") == 0, F.col("text"))).alias("text"),
    )
    complete = F.when(F.col("last") > 0, F.struct("split", "last"))
    tails = (
        last.withColumn("owner", F.last(complete, ignorenulls=True).over(earlier))
        .where("text IS NOT NULL")
        .groupBy("file", F.col("owner.split").alias("split"), F.col("owner.last").alias("last"))
        .agg(F.sort_array(F.collect_list(F.struct("split", "text"))).alias("parts"))
        .select(*split_key, "last", F.concat_ws("\n", "parts.text").alias("tail"))
    )
    crosses = F.col("record") == F.col("last")
    is_header = F.col("first") & (F.col("record") == 1)

    def refuse(what: str) -> Column:
        said = F.concat(F.lit(f"{what}, use read_csv: "), "file")
        return F.raise_error(said).cast("boolean")

    joined = F.concat_ws("\n", "text", "tail")
    whole = (
        pieces.where("record > 0")
        .join(tails, split_key, "left")
        .select(
            *split_key,
            "record",
            "first",
            F.when(crosses, joined).otherwise(F.col("text")).alias("text"),
        )
        .withColumn("text", F.rtrim(F.col("text"), F.lit("\r")))
        .where(
            F.when(is_header & (F.col("text") == ""), refuse("a blank line before the header"))
            .when(~F.col("text").rlike(STRICT_RECORD), refuse("a record that is not strict CSV"))
            .otherwise(~is_header)
        )
        .select("text")
        .where("text <> ''")
    )
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    parsed = F.from_csv("text", schema.simpleString(), {"escape": '"', "multiLine": "true"})
    return whole.select(parsed.alias("row")).select("row.*")


def read_tsv(
    spark: SparkSession, path: str, quote: str = '"', multi_line: bool = True
) -> DataFrame:
    """Tab-separated table with a header, all text, quoted as in `read_csv`.

    `quote=""` reads quotes literally, and then a line break always ends a row.
    """
    reader = spark.read.option("header", True).option("sep", "\t").option("quote", quote)
    if quote:
        reader = reader.option("escape", quote).option("multiLine", multi_line)
    return reader.csv(path)


def read_lines(spark: SparkSession, path: str, header: str | None = None) -> DataFrame:
    """Non-blank lines, stripped, in `line`.

    A header counts as a record like any other unless its text is given as `header`; then it
    is dropped where it is the first line of a file, and only there.
    """
    lines = spark.read.text(path).select(
        strip(F.col("value")).alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"),
    )
    if header:
        firsts = lines.where("split = 0").groupBy("file").agg(F.min_by("line", "seq").alias("line"), F.min("seq").alias("seq"))
        headers = firsts.where(F.col("line") == strip(F.lit(header))).select("file", "seq")
        lines = lines.join(headers, ["file", "seq"], "left_anti")
    return lines.select("line").where("line <> ''")


def read_windowed(
    spark: SparkSession,
    path: str,
    since: datetime.date | None = None,
    until: datetime.date | None = None,
) -> DataFrame:
    """Saved windowed counts. Reading the folder honours the stream sink's commit log.

    `since` and `until`, both included, keep windows that start on such days. A table that was
    saved by day has a column `day` and is read for these days only.
    """
    saved = spark.read.parquet(path)
    by_day = "day" in saved.columns
    day = F.col("day") if by_day else F.to_date("window.start")
    if since:
        saved = saved.where(day >= F.lit(since))
    if until:
        saved = saved.where(day <= F.lit(until))
    return saved.drop("day") if by_day else saved


def join_small_files(spark: SparkSession, path: str, joined: str, before: datetime.date) -> None:
    """Copy the days before a date of a table saved by day to `joined`, in few files a day.

    A stream leaves a file for each task and trigger. Days that `joined` has are not read again,
    and a copy that failed is simply repeated: a day's folder is replaced as a whole.
    """
    saved = spark.read.parquet(path).where(F.col("day") < F.lit(before))
    done = days_of(spark, joined)
    if done:
        saved = saved.where(~F.col("day").isin(done))
    # One task writes a day, or a part of it where that is large.
    writer = saved.hint("rebalance", "day").write.mode("overwrite").partitionBy("day")
    writer.option("partitionOverwriteMode", "dynamic").parquet(joined)


def days_of(spark: SparkSession, path: str) -> list[datetime.date]:
    """Days that a table saved by day holds, from the names of its files; none without a table."""
    try:
        files = list_files(spark, path, "*.parquet")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return []
        raise
    day = F.to_date(F.regexp_extract("path", "/day=([0-9-]+)/", 1))
    return sorted(row.day for row in files.select(day.alias("day")).distinct().collect())


def read_joined(
    spark: SparkSession,
    path: str,
    joined: str,
    since: datetime.date | None = None,
    until: datetime.date | None = None,
) -> DataFrame:
    """A table saved by day, of which `join_small_files` has copied some days."""
    done = days_of(spark, joined)
    if not done:
        return read_windowed(spark, path, since, until)
    rest = spark.read.parquet(path).where(~F.col("day").isin(done))
    copied = spark.read.schema(rest.schema).parquet(joined).where(F.col("day").isin(done))
    both = copied.unionByName(rest)
    if since:
        both = both.where(F.col("day") >= F.lit(since))
    if until:
        both = both.where(F.col("day") <= F.lit(until))
    return both.drop("day")


def read_bench_results(spark: SparkSession, path: str) -> DataFrame:
    """Result CSV under our column names; a name pattern reads several runs as one."""
    return spark.read.schema(BENCH_SCHEMA).option("header", True).csv(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """Run summary JSON."""
    return spark.read.schema(SUMMARY_SCHEMA).json(path)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """`(path, modified, bytes)` of the files below a path; none of them is opened."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return found.select(
        "path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes")
    )


def sink_files(spark: SparkSession, path: str) -> DataFrame:
    """`(path, modified, bytes, batch, line)` of the files a stream has committed to a folder.

    Read from the sink's commit log. A log file that merges earlier ones keeps their order in its
    lines and stands for its own batch, so files sort by batch and line. Spark's file sources pass
    over this folder as hidden, hence the RDD; each log file is one of its rows.
    """
    entry = "path string, size bigint, modificationTime bigint, action string"
    logs = spark.sparkContext.wholeTextFiles(f"{path.rstrip('/')}/_spark_metadata/[0-9]*")
    logs = spark.createDataFrame(logs, "log string, content string")
    lines = logs.select(
        F.regexp_extract(base_name(F.col("log")), "^([0-9]+)", 1).cast("bigint").alias("batch"),
        F.posexplode(F.split("content", "\n")).alias("line", "value"),
    )
    files = lines.where(F.col("value").startswith("{")).select(
        "batch", "line", F.from_json("value", entry).alias("file")
    )
    # The earliest log file that holds a file tells its batch best.
    found = files.where("file.action = 'add'").groupBy(F.col("file.path").alias("path")).agg(
        F.timestamp_millis(F.min("file.modificationTime")).alias("modified"),
        F.min("file.size").alias("bytes"),
        F.min(F.struct("batch", "line")).alias("place"),
    )
    return found.select("path", "modified", "bytes", "place.batch", "place.line")


def newest_files(
    spark: SparkSession, path: str, n: int = 5, by: str = "mtime", pattern: str = "*.parquet"
) -> list[str]:
    """Paths of the n newest files of a folder, newest first, from listings alone.

    `by="mtime"` orders by modification time, `by="name"` by path, and `by="batch"` by the batch
    of the stream that wrote the folder; ties go by path.
    """
    orders = {
        "mtime": [F.desc("modified"), F.desc("path")],
        "name": [F.desc("path")],
        "batch": [F.desc("batch"), F.desc("line"), F.desc("path")],
    }
    if by not in orders:
        raise ValueError(f"by must be one of {sorted(orders)}")
    files = sink_files(spark, path) if by == "batch" else list_files(spark, path, pattern)
    return [row.path for row in files.orderBy(*orders[by]).limit(n).collect()]


def latest_files(
    spark: SparkSession, path: str, n: int = 5, by: str = "mtime", pattern: str = "*.parquet"
) -> DataFrame:
    """Rows of the n newest Parquet files of a folder; no other file is opened."""
    newest = newest_files(spark, path, n, by, pattern)
    if not newest:
        return spark.read.parquet(path).limit(0)
    return spark.read.option("basePath", path).parquet(*newest)


def first_in_files(table: DataFrame, size: int) -> DataFrame:
    """The first `size` records of a Parquet table, in the order of its paths and rows.

    A record's number is its row index in the file and the rows of the files before it. Counts
    per file, one row each, tell the file of the cut; as literals its path and the rest let the
    scan skip what lies beyond. No key is needed and nothing is sorted but the counts.
    """
    if size <= 0:
        return table.limit(0)
    path, index = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    counts = table.groupBy(path.alias("path")).agg(F.count("*").alias("rows"))
    # One row per file.
    before = W.orderBy("path").rowsBetween(W.unboundedPreceding, -1)
    placed = counts.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    cut = placed.where(F.col("before") < size).orderBy(F.desc("path")).first()
    if cut is None:
        return table.limit(0)
    return table.where((path < cut.path) | ((path == cut.path) & (index < size - cut.before)))


def list_results(spark: SparkSession, path: str, suffix: str = ".csv") -> DataFrame:
    """`(folder, file_name, path)` of the files below a path that end in `suffix`."""
    return list_files(spark, path, f"*{suffix}").select(
        F.element_at(F.split("path", "/"), -2).alias("folder"),
        base_name(F.col("path")).alias("file_name"),
        "path",
    )
