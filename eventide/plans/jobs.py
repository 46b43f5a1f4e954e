"""End-to-end jobs built from the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventide.functions.timefmt import format_pane
from eventide.operators.aggregate import sum_per_key
from eventide.operators.panes import single_panes
from eventide.sources.text import parse_score_lines, scan_text, write_text


def team_scores_job(spark: SparkSession, input_path: str, output_path: str) -> DataFrame:
    """Score lines -> parse -> sum per team (global window) -> formatted panes -> text files.

    Returns the rejected lines (unparseable score or time) instead of failing.
    """
    good, rejects = parse_score_lines(scan_text(spark, input_path))
    panes = single_panes(sum_per_key(good.withColumnRenamed("team", "key")))
    text = format_pane("w_start", "w_end", "key", "value", "timing", "pane_index", "on_time_index", "is_first",
                       "is_last")
    write_text(panes.select(text.alias("value")), output_path)
    return rejects


def _main(argv: list[str] | None = None) -> None:
    import argparse

    from eventide.session import get_session

    ap = argparse.ArgumentParser(description="Sum team scores from score lines.")
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    args = ap.parse_args(argv)
    spark = get_session()
    rejects = team_scores_job(spark, args.input, args.output)
    n = rejects.count()
    if n:
        print(f"{n} lines rejected", flush=True)
    spark.stop()


if __name__ == "__main__":
    _main()

__all__ = ["team_scores_job"]
