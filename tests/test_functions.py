import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from driftline.functions import format_lsn, parse_lsn, row_hash, seconds_between
from driftline.functions.lsn import lsn_number, lsn_text
from driftline.functions.payload import first_int, members, number_or_null, text_or_null


def hashes(df, columns, method):
    return [r["h"] for r in df.select(row_hash(df, columns, method).alias("h")).collect()]


@pytest.mark.parametrize("method", ["xxh128", "sha256"])
def test_null_positions_and_boundaries_differ(spark, method):
    rows = [("a", None, "b"), ("a", "b", None), (None, "a", "b"), ("ab", "", None), ("a", "b", ""), ("~", None, None), (None, "~", None)]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    assert len(set(hashes(df, ["x", "y", "z"], method))) == len(rows)


@pytest.mark.parametrize("method", ["xxh128", "sha256"])
def test_equal_values_have_equal_hashes(spark, method):
    df = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert len(set(hashes(df, ["x"], method))) == 1
    nan = spark.range(2).select(F.when(F.col("id") == 0, F.lit(float("nan"))).otherwise(F.sqrt(F.lit(-1.0))).alias("x"))
    assert len(set(hashes(nan, ["x"], method))) == 1
    maps = spark.sql("select map('a', 1, 'b', 2) m union all select map('b', 2, 'a', 1)")
    assert len(set(hashes(maps, ["m"], method))) == 1


@pytest.mark.parametrize("method", ["xxh128", "sha256"])
def test_nested_nulls_differ(spark, method):
    df = spark.sql("select array(1, null) a, named_struct('p', null, 'q', 1) s union all select array(null, 1), named_struct('p', 1, 'q', null)")
    assert len(set(hashes(df, ["a"], method))) == 2
    assert len(set(hashes(df, ["s"], method))) == 2


def test_decimal_scale_and_zone(spark):
    df = spark.sql("select cast('1.50' as decimal(10,2)) d union all select cast(1.5 as decimal(10,2))")
    assert len(set(hashes(df, ["d"], "xxh128"))) == 1
    text = "select timestamp'2024-01-01 00:00:00+00:00' t"
    first = hashes(spark.sql(text), ["t"], "sha256")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert hashes(spark.sql(text), ["t"], "sha256") == first
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_many_columns_have_their_own_null_bits(spark):
    wide = spark.range(1).select(*[F.lit(None).cast("int").alias(f"c{i}") for i in range(130)])
    some = wide.withColumn("c125", F.lit(1))
    other = wide.withColumn("c126", F.lit(1))
    seen = {str(hashes(d, d.columns, "xxh128")) for d in (wide, some, other)}
    assert len(seen) == 3


def test_bad_arguments(spark):
    df = spark.range(1)
    with pytest.raises(ValueError):
        row_hash(df, ["id"], "md5")
    with pytest.raises(ValueError):
        row_hash(df, [])


def test_lsn_order_and_text(spark):
    df = spark.createDataFrame([("0/FF",), ("1/0",), ("A/1",), ("16/B374D848",), ("x/1",), ("1",), (None,)], "t string")
    rows = df.select("t", parse_lsn(F.col("t")).alias("n")).collect()
    assert [r["n"] for r in rows] == [255, 1 << 32, (10 << 32) + 1, (0x16 << 32) + 0xB374D848, None, None, None]
    back = df.select(format_lsn(parse_lsn(F.col("t"))).alias("b")).collect()
    assert [r["b"] for r in back[:4]] == ["0/FF", "1/0", "A/1", "16/B374D848"]
    assert lsn_number(lsn_text(123456789012)) == 123456789012


def test_seconds_between_kinds(spark):
    a, b = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2, 0, 0, 1, 500000)
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame([(a, b), (a, None)], f"a {kind}, b {kind}")
        out = [r["s"] for r in df.select(seconds_between(F.col("a"), F.col("b")).alias("s")).collect()]
        assert out == [86401.5, None]


def test_first_int_skips_what_does_not_read(spark):
    cases = {
        '{"a":"x","b":"7"}': 7,
        '{"a":"","b":3}': 3,
        '{"a":3.7}': 3,
        '{"a":"3.7","b":1}': 1,
        '{"a":" 12 "}': 12,
        '{"a":null,"b":"-4"}': -4,
        '{"a":0,"b":5}': 0,
        '{"a":[1]}': None,
        "{}": None,
        '{"a":true}': 1,
    }
    df = spark.createDataFrame([(k,) for k in cases], "p string").withColumn("m", members(F.col("p"), ("a", "b")))
    assert [r["v"] for r in df.select(first_int("m", "a", "b").alias("v")).collect()] == list(cases.values())


def test_number_and_text(spark):
    df = spark.createDataFrame([('{"a":"1.5"}', " x\t"), ('{"a":2}', " \n "), ('{"a":"z"}', None)], "p string, t string")
    df = df.withColumn("m", members(F.col("p"), ("a",)))
    rows = df.select(number_or_null(F.col("m.a")).alias("n"), text_or_null(F.col("t")).alias("t")).collect()
    assert [tuple(r) for r in rows] == [(1.5, "x"), (2.0, None), (None, None)]
    assert not any(math.isnan(r["n"]) for r in rows if r["n"] is not None)
