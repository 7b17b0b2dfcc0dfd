import math

import duckdb
from pyspark.sql import functions as F

from canopy.functions.columns import (
    child_id,
    entropy,
    flag_to_boolean,
    hash_bucket,
    ratio_above,
    rating_bucket,
    squared_error,
    text_length,
    value_of,
)


def one(spark, expr, schema, rows):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_ratio_above_edge_cases(spark):
    rows = [("3", "4"), ("1", "2"), ("1", "0"), ("0", "0"), (None, "3"), ("2", None), ("2", "x"), ("5", "3")]
    got = one(spark, ratio_above("h", "t", 0.5), "h string, t string", rows)
    # 0.75 true; exactly 0.5 false (strict); zero, null and non-numeric denominators false
    assert got == [True, False, False, False, False, False, False, True]


def test_rating_bucket(spark):
    rows = [(None,), ("1",), ("2",), ("3",), ("4",), ("5",), ("x",), ("0",)]
    got = one(spark, rating_bucket("r"), "r string", rows)
    assert got == ["bad", "bad", "good", "regular", "good", "good", "bad", "bad"]


def test_text_length_null_and_non_bmp(spark):
    rows = [(None,), ("",), ("abc",), ("a\U0001F600",)]
    got = one(spark, text_length("t"), "t string", rows)
    # characters, not UTF-16 units: the emoji counts once
    assert got == [0.0, 0.0, 3.0, 2.0]


def test_flag_to_boolean(spark):
    got = one(spark, flag_to_boolean("f"), "f string", [("Y",), ("N",), (None,), ("y",)])
    assert got == [True, False, False, False]


def test_entropy_values(spark):
    rows = [(9, 5), (0, 7), (3, 3), (0, 0), (1, 3)]
    got = one(spark, entropy("p", "n"), "p long, n long", rows)
    def h(p, n):
        t = p + n
        return -sum(c / t * math.log2(c / t) for c in (p, n) if c) if t else 0.0
    for g, (p, n) in zip(got, rows):
        assert abs(g - h(p, n)) < 1e-12
    assert abs(got[0] - 0.940285958) < 1e-9


def test_hash_bucket_matches_duckdb(spark):
    keys = ["1", "12-3", "abc", "", "ünï", "9999999"]
    got = one(spark, hash_bucket("k"), "k string", [(k,) for k in keys])
    want = [duckdb.sql(f"SELECT ('0x' || substr(md5('{k}'), 1, 8))::BIGINT % 100").fetchall()[0][0] for k in keys]
    assert got == want
    assert all(0 <= b < 100 for b in got)


def test_squared_error(spark):
    rows = [(True, "true"), (True, "false"), (False, "true"), (False, "false"), (None, "true")]
    got = one(spark, squared_error("y", "p"), "y boolean, p string", rows)
    assert got == [0.0, 1.0, 1.0, 0.0, 1.0]


def test_value_of_and_child_id(spark):
    df = spark.createDataFrame([("a1", "b1", "a"), ("a2", "b'2", "b")], "a string, b string, which string")
    vals = [r[0] for r in df.select(value_of(F.col("which"), ["a", "b"])).collect()]
    assert vals == ["a1", "b'2"]
    ids = [r[0] for r in df.select(child_id(F.lit("root"), F.col("which"), value_of(F.col("which"), ["a", "b"]))).collect()]
    want = [duckdb.sql("SELECT md5('root|a=a1')").fetchall()[0][0], duckdb.sql("SELECT md5('root|b=b''2')").fetchall()[0][0]]
    assert ids == want
