import pytest
from pyspark.sql import functions as F

from conftest import rows
from loomtext.functions.bits import day_boundary_ms, day_to_bit
from loomtext.operators.activity import active_days
from loomtext.operators.joins import key_join
from loomtext.operators.sampling import hash_sample, one_per_key, train_test_split, two_stage_sample


def test_activity_golden(spark):
    ev = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (1, 2), (2, 30)], "u long, d int")
    assert rows(active_days(ev, "u", "d")) == [(1, 7, 3), (2, 536870912, 1)]


@pytest.mark.parametrize("day", [0, 31])
def test_activity_rejects_bad_day(spark, day):
    df = spark.createDataFrame([(day,)], "d int")
    with pytest.raises(Exception):
        df.select(day_to_bit(F.col("d"))).collect()


def test_day_boundary(spark):
    df = spark.createDataFrame([("2024-01-10 13:45:00",)], "s string").select(F.to_timestamp("s").alias("ts"))
    r = df.select(day_boundary_ms("ts", 0).alias("a"), day_boundary_ms("ts", 7).alias("b")).first()
    assert r["a"] == 1704844800000 and r["b"] == 1704844800000 - 7 * 86400000


def test_key_join_golden(spark):
    kv = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string")
    keys = spark.createDataFrame([("a",), ("a",), ("c",)], "key string")
    assert rows(key_join(kv, keys)) == [("a", "1"), ("a", "1")]
    assert rows(key_join(kv, keys, semi=True)) == [("a", "1")]


def test_one_per_key_golden(spark):
    df = spark.createDataFrame([(4, "t", "x"), (2, "t", "y"), (3, None, "z"), (1, None, "w")],
                               "rec_id long, title string, url string")
    assert rows(one_per_key(df, "title", "rec_id"), "title", "rec_id", "url") == [("t", 2, "y"), (None, 1, "w")]
    kept = rows(one_per_key(df, "title", "rec_id", keep_null_keys=True), "title", "rec_id", "url")
    assert kept == [("t", 2, "y"), (None, 1, "w"), (None, 3, "z")]
    assert rows(one_per_key(df.repartition(5), "title", "rec_id")) == rows(one_per_key(df.coalesce(1), "title", "rec_id"))


def test_sampling_is_layout_invariant(spark):
    df = spark.range(0, 3000).withColumnRenamed("id", "k")
    a = rows(hash_sample(df.repartition(1), "k", 0.1))
    b = rows(hash_sample(df.repartition(13), "k", 0.1))
    assert a == b and 200 < len(a) < 400
    two = rows(two_stage_sample(df, "k", 0.5, 0.5))
    assert 500 < len(two) < 1000  # independent salts: about a quarter survives
    train, test = train_test_split(df, "k", 0.3)
    assert train.count() + test.count() == 3000 and 700 < test.count() < 1100


def test_small_fractions_keep_rows(spark):
    df = spark.range(1_000_000).withColumnRenamed("id", "k")
    assert 300 < hash_sample(df, "k", 0.0004).count() < 500
    assert 1450 < hash_sample(df, "k", 0.0016).count() < 1750
