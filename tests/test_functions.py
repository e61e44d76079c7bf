"""Date and bit helpers against Python's own calendar arithmetic."""

import datetime as dt

from pyspark.sql import functions as F

from agora.functions import bits, dates


def test_iso_week_edges(spark):
    days = [dt.date(2024, 1, 7), dt.date(2024, 1, 8), dt.date(2024, 1, 14), dt.date(2024, 1, 15),
            dt.date(2024, 12, 30), dt.date(2023, 1, 1), dt.date(2020, 12, 31), dt.date(2021, 1, 3)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select("d", dates.iso_week("d").alias("w"), dates.week_start("d").alias("m")).collect()
    for r in got:
        assert r.w == r.d.isocalendar()[1]
        assert r.m == r.d - dt.timedelta(days=r.d.weekday())
    assert dates.iso_week_monday(2024, 2) == dt.date(2024, 1, 8)
    assert dates.iso_week_monday(2025, 1) == dt.date(2024, 12, 30)


def test_epoch_conversions(spark):
    df = spark.createDataFrame([(1704672000.0,), (1704758399.999999,), (1704758400.0,)], "e double")
    got = df.select(
        dates.epoch_to_date("e").alias("d"), dates.epoch_to_day_text("e").alias("t"),
        dates.day_window("e", dt.date(2024, 1, 8)).alias("in_day"),
    ).collect()
    assert [(r.d, r.t, r.in_day) for r in got] == [
        (dt.date(2024, 1, 8), "2024-01-08", True),
        (dt.date(2024, 1, 8), "2024-01-08", True),
        (dt.date(2024, 1, 9), "2024-01-09", False),
    ]
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 8, 12, 30),)], "t timestamp_ntz")
    assert ts.select(dates.epoch_seconds("t")).first()[0] == 1704672000.0 + 12.5 * 3600


def test_bits(spark):
    df = spark.createDataFrame([(0,), (1,), (64,), (127,), (0b1011111,)], "m int")
    got = df.select(
        bits.week_mask_string("m").alias("s"), bits.popcount("m").alias("n"),
        bits.bit_string(F.col("m").cast("bigint") * 2 ** 25, 32).alias("b32"), bits.mask_has("m", "1011111").alias("h"),
    ).collect()
    for r, m in zip(got, [0, 1, 64, 127, 0b1011111]):
        assert r.s == format(m, "07b") and r.n == bin(m).count("1")
        assert r.b32 == format(m << 25, "032b") and r.b32[:7] == r.s
        assert r.h == (m & 0b1011111 == 0b1011111)
    monday = dt.date(2024, 1, 8)
    days = spark.createDataFrame([(monday + dt.timedelta(days=i),) for i in range(-1, 8)], "d date")
    assert [r[0] for r in days.select(bits.day_bit("d", monday)).collect()] == [0, 1, 2, 4, 8, 16, 32, 64, 0]
