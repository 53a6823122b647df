import pytest
from pyspark.sql import functions as F

from strandmill.functions.keyed import attach, split_repeated
from strandmill.functions.lineage import checkpoint_folder


@pytest.mark.parametrize("rows", [0, 100])
def test_split_repeated(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d"), (None, "d"), (3, None)], "k int, v string")
    single, several = split_repeated(df, "k", rows=rows)
    assert sorted(r.v or "" for r in single.collect()) == ["", "a"] and sorted(r.v for r in several.collect()) == ["b", "c", "d", "d"]
    assert all(x.count() == 0 for x in split_repeated(df.limit(0), "k", rows=rows))


def test_attach_splits_hot_keys(spark):
    rows = spark.range(5000).select((F.col("id") % 7).alias("k"), "id")
    small = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top")).filter("k < 5")
    assert attach(rows, small, "k", "n", 5000).count() == rows.filter("k < 5").count()


def test_checkpoint_folder_is_the_sessions(spark):
    assert spark.conf.get("spark.checkpoint.dir") in checkpoint_folder(spark)
