import pytest
from pyspark.sql import functions as F

from driftline.operators.error_lines import is_json, normalize_error_lines, replace_stage_errors, write_stage_errors

JSON = {
    '{"a":1}': True,
    " [1, 2] ": True,
    '"text"': True,
    "12": True,
    "null": True,
    '{"a":"it\'s"}': True,
    '{"a":"\\"quoted\\""}': True,
    '{"a":1,"a":2}': True,
    '{"a":1} xyz': False,
    '{"a":1},{"b":2}': False,
    '{"a":1}] [{': False,
    "1] [2": False,
    '1} {"x":2': False,
    "{'a':1}": False,
    '{"a":1': False,
    '{"a":"x}': False,
    "nope": False,
    "": False,
    '{"a":"tab\there"}': False,
}


def test_json_syntax(spark):
    df = spark.createDataFrame([(k,) for k in JSON], "line string")
    got = {r["line"]: r["ok"] for r in df.select("line", is_json(F.col("line")).alias("ok")).collect()}
    assert got == JSON


def test_long_strings_are_read_whole(spark):
    long = '{"a":"' + "x\\n" * 200_000 + '"}'
    df = spark.createDataFrame([(long,), (long[:-1],)], "line string")
    assert [r["ok"] for r in df.select(is_json(F.col("line")).alias("ok")).collect()] == [True, False]


def normalized(spark, lines):
    rows = [("r", "p", i, line) for i, line in enumerate(lines)]
    df = spark.createDataFrame(rows, "run_id string, part string, n bigint, line string")
    return normalize_error_lines(df, ["run_id"]).orderBy("n").collect()


def test_field_defaults(spark):
    empties = ['{"field":"","code":null,"message":0}', "{}", '{"field":false,"code":[],"message":{}}', '{"field":-0.0,"code":"","message":0e5}']
    for row in normalized(spark, empties):
        assert (row["field"], row["code"], row["message"]) == ("$", "validation_error", "validation error")
    (kept,) = normalized(spark, ['{"field":"  ","code":"0","message":"false"}'])
    assert (kept["field"], kept["code"], kept["message"]) == ("  ", "0", "false")
    (other,) = normalized(spark, ['{"field":5,"code":"[]","message":"x"}'])
    assert (other["field"], other["code"]) == ("5", "[]")


def test_values(spark):
    rows = normalized(spark, ['{"row_number":3.7,"constraint":0,"actual_value":"  "}', '{"row_number":"3.7","constraint":" c "}', '{"row_number":" 12 "}', '{"row_number":""}', '{"row_number":1e3}'])
    assert [r["row_number"] for r in rows] == [3, None, 12, None, 1000]
    assert [r["constraint"] for r in rows] == ["0", "c", None, None, None]
    assert rows[0]["actual_value"] is None
    assert rows[0]["details_json"] == '{"row_number":3.7,"constraint":0,"actual_value":"  "}'


def test_blank_and_other_lines_are_passed_over(spark):
    assert len(normalized(spark, ["", "   ", "[1]", "7", '"{"', '{"field":"f"}'])) == 1


def test_one_broken_line_drops_the_artifact(spark):
    assert normalized(spark, ['{"field":"f"}', "{broken", '{"field":"g"}']) == []


def test_other_artifacts_are_unharmed(spark):
    rows = [("a", 1, "{bad"), ("a", 2, "{}"), ("b", 1, "{}")]
    df = spark.createDataFrame(rows, "run_id string, n int, line string")
    assert [r["run_id"] for r in normalize_error_lines(df, ["run_id"]).collect()] == ["b"]


def test_an_empty_set_clears_the_stage(spark, tmp_path):
    table = spark.createDataFrame([("r", "s", 1), ("r", "t", 2)], "run_id string, stage_name string, v int")
    stages = spark.createDataFrame([("r", "s")], "run_id string, stage_name string")
    assert [r["v"] for r in replace_stage_errors(table, table.limit(0), stages).collect()] == [2]
    for name, value in (("s", 1), ("t", 2)):
        write_stage_errors(spark, str(tmp_path), table.filter(F.col("stage_name") == name), "r", name)
    write_stage_errors(spark, str(tmp_path), table.limit(0), "r", "s")
    left = spark.read.schema("v int, run_id string, stage_name string").parquet(str(tmp_path))
    assert [(r["stage_name"], r["v"]) for r in left.collect()] == [("t", 2)]


def test_a_failed_write_keeps_the_old_errors(spark, tmp_path):
    old = spark.createDataFrame([("r", "s", 1)], "run_id string, stage_name string, v int")
    write_stage_errors(spark, str(tmp_path), old, "r", "s")
    broken = old.withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        write_stage_errors(spark, str(tmp_path), broken, "r", "s")
    assert [r["v"] for r in spark.read.parquet(str(tmp_path)).collect()] == [1]
    write_stage_errors(spark, str(tmp_path), old.withColumn("v", F.lit(2)), "r", "s")
    assert [r["v"] for r in spark.read.parquet(str(tmp_path)).collect()] == [2]


@pytest.mark.parametrize("shuffled", [False, True])
def test_hot_artifact(spark, monkeypatch, shuffled):
    import driftline.operators.error_lines as module
    from driftline.shared import keyed_join

    if shuffled:
        monkeypatch.setattr(module, "keyed_join", lambda b, s, k, h: keyed_join(b, s, k, h, limit_bytes=0))
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 9)).alias("run_id"),
        F.col("id").alias("n"),
        F.when(F.col("id") == 4, "{bad").otherwise("{}").alias("line"),
    )
    rows = normalize_error_lines(df, ["run_id"]).groupBy("run_id").count().collect()
    counts = {r["run_id"]: r["count"] for r in rows}
    assert counts["hot"] == 300 and "r4" not in counts and sum(counts.values()) == 800
