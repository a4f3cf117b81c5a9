import datetime as dt

from pyspark.sql import functions as F

from gridplace import functions as G


def one(spark, *cols):
    return spark.range(1).select(*cols).collect()[0]


def test_oracle_greatest_least_propagate_null(spark):
    r = one(
        spark,
        G.oracle_greatest(F.lit(1), G.oracle_least(F.lit(2), F.lit(None).cast("double"))).alias("o"),
        F.greatest(F.lit(1), F.least(F.lit(2), F.lit(None).cast("double"))).alias("s"),
        G.oracle_greatest(F.lit(1), G.oracle_least(F.lit(2), F.lit(1.5))).alias("v"),
    )
    assert r.o is None and r.s == 2 and r.v == 1.5


def test_week_start_is_sunday(spark):
    # 1998-06-30 is a Tuesday; Oracle TRUNC(d,'DAY') gives Sunday 1998-06-28
    r = one(spark, G.week_start(F.lit("1998-06-30").cast("date")).alias("w"),
            G.snapshot_week("1998-07-01").alias("s"), G.week_start(F.lit("1998-06-28").cast("date")).alias("same"))
    assert r.w == dt.date(1998, 6, 28) and r.s == dt.date(1998, 6, 28) and r.same == dt.date(1998, 6, 28)


def test_falsy_default_and_nvl(spark):
    df = spark.createDataFrame([(None,), (0,), (3000,)], "x int")
    assert [r.y for r in df.select(G.falsy_default("x", 2000).alias("y")).collect()] == [2000, 2000, 3000]
    assert [r.y for r in df.select(G.nvl("x", 0).alias("y")).collect()] == [0, 0, 3000]


def test_to_double_or_null(spark):
    df = spark.createDataFrame([("1.5",), ("n/a",), ("NaN",), (None,), ("-3",)], "t string")
    assert [r.d for r in df.select(G.to_double_or_null("t").alias("d")).collect()] == [1.5, None, None, None, -3.0]


def test_safe_div_no_error_under_ansi(spark):
    r = one(spark, G.safe_div(F.lit(1), F.lit(0)).alias("z"), G.safe_div(F.lit(1), F.lit(4)).alias("q"))
    assert r.z is None and r.q == 0.25


def test_rounding_modes(spark):
    r = one(spark, G.sql_round(F.lit(0.125), 2).alias("up"), G.pandas_round(F.lit(0.125), 2).alias("even"),
            G.sql_round(F.lit(-2.5), 0).alias("neg"), G.pandas_round(F.lit(1e25), 2).alias("big"))
    assert r.up == 0.13 and r.even == 0.12 and r.neg == -3.0 and r.big == 1e25


def test_whole_seconds_truncates_fractions(spark):
    a = F.lit("2024-01-01 10:00:00.900").cast("timestamp_ntz")
    b = F.lit("2024-01-01 10:01:00.100").cast("timestamp_ntz")
    assert one(spark, G.whole_seconds_between(a, b).alias("s")).s == 60


def test_dataset_split(spark):
    df = spark.createDataFrame([("mc16:mc16.123.x",), ("data18.456.y",)], "d string")
    rows = df.select(G.dataset_scope("d").alias("s"), G.dataset_name("d").alias("n")).collect()
    assert (rows[0].s, rows[0].n) == ("mc16", "mc16.123.x")
    assert (rows[1].s, rows[1].n) == ("data18", "data18.456.y")


def test_trailing_window_bounds(spark):
    df = spark.createDataFrame(
        [(dt.datetime(1998, 6, 23, 23, 59),), (dt.datetime(1998, 6, 24),), (dt.datetime(1998, 6, 30, 23),),
         (dt.datetime(1998, 7, 1),)], "t timestamp_ntz")
    kept = df.filter(G.trailing_window("t", "1998-07-01", 7)).count()
    assert kept == 2
