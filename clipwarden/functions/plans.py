"""Table functions."""

from __future__ import annotations

from pyspark.sql import SparkSession


def register_clip_plan(spark: SparkSession) -> None:
    """SQL table function `clip_plan(duration, clip_seconds)`: the back-to-back clips that fit into a duration."""
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION clip_plan(duration DOUBLE, clip_seconds DOUBLE)
        RETURNS TABLE (clip_no BIGINT, clip_start DOUBLE)
        RETURN SELECT k, (k - 1) * clip_seconds FROM explode(
          CASE WHEN duration >= clip_seconds THEN sequence(1L, CAST(floor(duration / clip_seconds) AS BIGINT)) END) AS t(k)"""
    )
