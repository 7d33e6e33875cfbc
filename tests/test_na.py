"""Missing-value rules (one test per rule, rows from the fixtures table)."""

from decimal import Decimal

from pyspark.sql import functions as F

from fleetzone.functions import na


def _one(df, col):
    return df.collect()[0][col]


def test_n_distinct_counts_null_once(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "x int")
    assert _one(df.agg(na.n_distinct("x").alias("n")), "n") == 3
    assert _one(df.agg(F.count_distinct("x").alias("n")), "n") == 2


def test_n_distinct_empty_input_is_zero(spark):
    df = spark.createDataFrame([], "x int")
    assert _one(df.agg(na.n_distinct("x").alias("n")), "n") == 0


def test_n_distinct_where(spark):
    df = spark.createDataFrame([(True, "a"), (True, None), (False, "b"), (None, "c")], "t boolean, k string")
    assert _one(df.agg(na.n_distinct_where(F.col("t"), "k").alias("n")), "n") == 2


def test_strict_and_skipping_sums(spark):
    df = spark.createDataFrame([(1,), (None,), (2,)], "x int")
    assert _one(df.agg(na.sum_strict("x").alias("s")), "s") is None
    assert _one(df.agg(na.sum_skip("x").alias("s")), "s") == 3
    nulls = spark.createDataFrame([(None,), (None,)], "x int")
    assert _one(nulls.agg(na.sum_skip("x").alias("s")), "s") == 0


def test_strict_sum_where_ignores_other_rows(spark):
    df = spark.createDataFrame([(1, 1), (0, None), (1, 2)], "f int, x int")
    assert _one(df.agg(na.sum_strict_where(F.col("f") == 1, "x").alias("s")), "s") == 3
    assert _one(df.agg(na.sum_strict_where(F.col("f") == 0, "x").alias("s")), "s") is None


def test_if_else_null_test_gives_null(spark):
    df = spark.createDataFrame([(None, 10.0), ("ROUND", 10.0), ("DRESSED", 10.0)], "u string, q double")
    out = [r.v for r in df.select(na.if_else(F.col("u") == "ROUND", F.col("q") * 0.8, F.col("q")).alias("v")).collect()]
    assert out == [None, 8.0, 10.0]


def test_share_half_even_ties(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (57, 200), (0, 0), (2, 3), (1, 3)], "m long, n long")
    got = [r.s for r in df.select(na.share("m", "n").alias("s")).collect()]
    assert got == [0.12, 0.38, 0.28, None, 0.67, 0.33]


def test_share_on_decimals(spark):
    df = spark.createDataFrame([(Decimal("0.125"), Decimal("1.000"))], "m decimal(10,3), n decimal(10,3)")
    assert _one(df.select(na.share("m", "n", scale=3).alias("s")), "s") == 0.12


def test_fill_missing_numbers_text_and_nan(spark):
    df = spark.createDataFrame([(None, None, float("nan"))], "k string, n long, p double")
    r = na.fill_missing(df).collect()[0]
    assert (r.k, r.n, r.p) == ("0", 0, 0.0)
