"""What Python workers keep between tasks."""

import pyarrow as pa
from pyspark.sql import functions as F

from termtide.llm import common, decontaminate, pii


def test_one_object_is_kept():
    built = []

    def make(name):
        built.append(name)
        return name

    try:
        assert common.held("a", lambda: make("a")) == "a"
        assert common.held("a", lambda: make("a")) == "a"
        assert common.held("b", lambda: make("b")) == "b"
        assert list(common._held) == ["b"] and built == ["a", "b"]
        common.let_go()
        assert not common._held
        assert common.held("b", lambda: make("b")) == "b" and built == ["a", "b", "b"]
    finally:
        common.let_go()


def test_long_texts_come_in_small_batches(spark):
    """Texts of 1 MB and more in one partition are cut into batches by bytes, and none is lost."""
    texts = spark.range(0, 24, 1, 1).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("one two three "), 75_000).alias("text"),
    )
    items = spark.createDataFrame([(1, "two three one two")], "item_id bigint, text string")
    found = decontaminate.benchmark_hits(texts, items).select("n_words", F.size("hits").alias("n"))
    assert [tuple(r) for r in found.distinct().collect()] == [(225_000, 224_998)]

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    pii.use_text_batches(spark)
    counts = [r.n for r in texts.mapInArrow(sizes, "n bigint").collect()]
    assert sum(counts) == 24 and max(counts) <= 9
