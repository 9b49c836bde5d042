"""The scalar rules as SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from clipwarden.spec import TargetSpec

_HOST = "lower(coalesce(try_parse_url(trim(url), 'HOST'), ''))"
_PATH = "coalesce(try_parse_url(trim(url), 'PATH'), '')"
_VALUE = "try_parse_url(trim(url), 'QUERY', 'v')"


def definitions(spec: TargetSpec = TargetSpec()) -> dict[str, str]:
    """Signature and body per function."""
    off = lambda v, t: f"least(abs(cast({v} as double) - {t}D) / {t}D, 1D)"
    return {
        "canonical_source_key": f"""(url STRING) RETURNS STRING RETURN coalesce(
            'https://www.youtube.com/watch?v=' || coalesce(
                CASE WHEN {_HOST} = 'youtu.be' THEN nullif(trim(BOTH '/' FROM {_PATH}), '') END,
                CASE WHEN {_HOST} = 'youtube.com' OR endswith({_HOST}, '.youtube.com') THEN coalesce(
                    nullif(trim(coalesce(try_url_decode({_VALUE}), {_VALUE})), ''),
                    nullif(trim(regexp_extract({_PATH}, '^/+(shorts|embed|v)/+([^/]+)', 2)), '')) END),
            trim(url))""",
        "clean_id": """(value STRING, fallback STRING) RETURNS STRING RETURN coalesce(nullif(trim(BOTH '_' FROM
            regexp_replace(coalesce(nullif(value, ''), fallback), '[^\\\\p{L}\\\\p{N}_.-]', '_')), ''), fallback)""",
        "slug": """(value STRING) RETURNS STRING RETURN
            lower(trim(BOTH '_' FROM regexp_replace(value, '[^A-Za-z0-9_.-]+', '_')))""",
        "hamming": "(a BIGINT, b BIGINT) RETURNS INT RETURN bit_count(a ^ b)",
        "dhash": """(gray ARRAY<DOUBLE>, cols INT, bit_rows INT) RETURNS BIGINT RETURN aggregate(
            transform(sequence(0, cols * bit_rows - 1), i -> CASE WHEN
                gray[(i div cols) * (cols + 1) + i % cols] > gray[(i div cols) * (cols + 1) + i % cols + 1]
                THEN 1L ELSE 0L END),
            0L, (acc, b) -> shiftleft(acc, 1) | b)""",
        "conformance": f"""(width INT, height INT, frames INT, fps DOUBLE, duplicate_ratio DOUBLE)
            RETURNS DOUBLE RETURN 1D - ({off('width', spec.width)} + {off('height', spec.height)}
            + {off('frames', spec.frames)}
            + CASE WHEN fps > 0 THEN {off('fps', spec.fps)} ELSE 0.25D END
            + least(abs(cast(width as double) / cast(greatest(height, 1) as double) - {spec.width / spec.height!r}D), 1D)
            + duplicate_ratio) / 6D""",
        "timelapse_score": """(duplicate_ratio DOUBLE, high_motion DOUBLE, mean DOUBLE, std DOUBLE)
            RETURNS DOUBLE RETURN CASE WHEN duplicate_ratio < 0.05D AND high_motion > 0.30D AND mean > 0.0025D
            THEN least(high_motion * 0.7D + (1D - least(std / greatest(mean, 1e-6D), 1D)) * 0.3D, 1D)
            ELSE 0D END""",
        "grade_clip": """(conformance DOUBLE, dup DOUBLE, timelapse DOUBLE, mean_delta DOUBLE, cuts INT,
            clipping DOUBLE) RETURNS STRING RETURN CASE
            WHEN cuts > 0 OR dup > 0.05D OR timelapse > 0.5D OR mean_delta < 0.005D OR clipping > 0.15D
                OR conformance < 0.5D THEN 'FAIL'
            WHEN conformance >= 0.9D AND dup < 0.03D AND timelapse < 0.3D AND clipping < 0.08D THEN 'PASS'
            ELSE 'REVIEW' END""",
    }


def register(spark: SparkSession, spec: TargetSpec = TargetSpec()) -> list[str]:
    """Create the functions as temporary SQL functions; they are inlined by the optimizer."""
    made = definitions(spec)
    for name, body in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return sorted(made)
