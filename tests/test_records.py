from pyspark.sql import functions as F

from conftest import rows
from loomtext.functions.records import field_value, last_field, record_identity, record_pairs


def test_identity_golden(spark):
    df = spark.createDataFrame([("uid=null`imei=`snid=`sn=1-22-3",), ("sn=1-2",), ("uid= `imei=X",),
                                ("uid=NULL`snid= k ",), ("sn=a-b-c-",)], "line string")
    got = [r[0] for r in df.select(record_identity(F.col("line"))).collect()]
    assert got == ["22", "", "X", "k", "b"]


def test_field_lookup_anchoring(spark):
    df = spark.createDataFrame([("xuid=9`uid=5",), ("a=1",)], "line string")
    anchored = [r[0] for r in df.select(field_value(F.col("line"), "uid")).collect()]
    loose = [r[0] for r in df.select(field_value(F.col("line"), "uid", anchored=False)).collect()]
    assert anchored == ["5", ""] and loose == ["9", ""]


def test_last_field_wins(spark):
    df = spark.createDataFrame([("url=a`tit=t1`url=b",), ("kw=x",)], "line string")
    got = [tuple(r) for r in df.select(last_field(F.col("line"), "url"), last_field(F.col("line"), "tit")).collect()]
    assert got == [("b", "t1"), (None, None)]


def test_record_pairs(spark):
    df = spark.createDataFrame([(1, "a=1` b=2=3 `c``a=4"), (2, "")], "rec_id long, value string")
    got = rows(record_pairs(df))
    assert got == [(1, "a", "4"), (1, "b", "2=3"), (1, "c", "")]
