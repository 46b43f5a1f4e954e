"""Time arithmetic and text forms."""

from pyspark.sql import functions as F

from eventide.functions.timefmt import ceil_to, dur_us, floor_to, format_time, format_window, pane_time_text


def test_durations():
    assert dur_us("2 minutes") == 120_000_000
    assert dur_us("1 hour 30 minutes") == 5_400_000_000
    assert dur_us("59 seconds 999999 microseconds") == 59_999_999
    assert dur_us(1.5) == 1_500_000


def test_boundaries_and_text(spark):
    t = F.lit("1970-01-01 12:06:00").cast("timestamp_ntz")
    u = F.lit("1970-01-01 12:06:01").cast("timestamp_ntz")
    none = F.lit(None).cast("timestamp_ntz")
    row = spark.range(1).select(
        format_time(ceil_to(t, "2 minutes", "1 minute")).alias("c_mid"),
        format_time(ceil_to(F.lit("1970-01-01 12:07:00").cast("timestamp_ntz"), "2 minutes", "1 minute"))
        .alias("c_exact"),
        format_time(ceil_to(u, "2 minutes", "1 minute")).alias("c_next"),
        format_time(floor_to(u, "2 minutes")).alias("f"),
        format_window(none, none).alias("g"),
        format_window(t, none).alias("open"),
        pane_time_text(t, none).alias("open_time"),
        pane_time_text(none, none).alias("global_time"),
        format_time(none).alias("null_text"),
    ).first()
    # Aligned boundaries at odd minutes: a time on a boundary stays, others move to the next one.
    assert row.c_mid == "12:07:00" and row.c_next == "12:07:00" and row.c_exact == "12:07:00"
    assert row.f == "12:06:00"
    assert row.g == "[global window]"
    assert row.open == "[12:06:00, END_OF_GLOBAL_WINDOW)"
    assert row.open_time == "04:00:54" and row.global_time == "END_OF_GLOBAL_WINDOW"
    assert row.null_text == "null"
