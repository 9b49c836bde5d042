"""Queries of aggregates and profiles (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipwarden.operators import compare, grade, joins, profile
from clipwarden.plans import bindings as b
from clipwarden.plans.registry import query
from clipwarden.plans.rule_queries import listed_files

c = F.col


@query(
    "A01_quality_summary",
    f"""WITH {b.GRADED_SQL} SELECT count(*) AS total, count(*) FILTER (grade = 'PASS') AS pass, count(*) FILTER (grade = 'REVIEW') AS review,
    count(*) FILTER (grade = 'FAIL') AS fail, round(count(*) FILTER (grade = 'PASS') / count(*)::DOUBLE, 9) AS pass_rate,
    round(count(*) FILTER (grade = 'REVIEW') / count(*)::DOUBLE, 9) AS review_rate, round(count(*) FILTER (grade = 'FAIL') / count(*)::DOUBLE, 9) AS fail_rate,
    round(avg(conformance_score), 6) AS mean_conformance_score, round(avg(duplicate_frame_ratio), 6) AS mean_duplicate_frame_ratio,
    round(avg(timelapse_score), 6) AS mean_timelapse_score, round(avg(temporal_diff_mean), 6) AS mean_temporal_diff_mean FROM graded""",
)
def a01(spark, d):
    t = grade.quality_summary(b.graded(spark, d))
    return t.select(
        "total", "pass", "review", "fail",
        *[F.round(k, 9 if k.endswith("rate") else 6).alias(k) for k in t.columns[4:]],
    )


@query(
    "A02_issues_by_category",
    f"WITH {b.GRADED_SQL} SELECT trim(split_part(split_part(reason, '=', 1), ';', 1)) AS category, count(*) AS n FROM graded GROUP BY 1",
)
def a02(spark, d):
    return grade.issues_by_category(b.graded(spark, d))


_WIDE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "A04_mean_min_max",
    " UNION ALL ".join(
        f"SELECT '{k}' AS key, round(avg({k}), 4) AS mean, abs(min({k})) AS min, max({k}) AS max FROM lineitem" for k in _WIDE
    ),
)
def a04(spark, d):
    t = profile.mean_min_max(b.table(spark, d, "lineitem"), _WIDE)
    return t.select("key", F.round("mean", 4).alias("mean"), F.abs("min").alias("min"), "max")


@query(
    "A05_storage_totals",
    """SELECT round(sum((o_orderkey % 100) / 8e0) / 1024e0, 9) AS total_gb, max((o_orderkey % 100) / 8e0) AS largest_mb FROM orders WHERE o_orderkey % 21 <> 0""",
)
def a05(spark, d):
    return profile.storage_totals(listed_files(spark, d)).withColumn("total_gb", F.round("total_gb", 9))


_STATS = """count(v) AS n, round(avg(v), 6) AS mean, round({std}(v), 6) AS std, min(v) AS min, {q}, max(v) AS max"""


def _q(probs: dict[str, float]) -> str:
    return ", ".join(f"round(quantile_cont(v, {p}), 6) AS {k}" for k, p in probs.items())


def _rounded(t, exact=("key", "n", "min", "max", "rows")):
    return t.select(*[c(k) if k in exact else F.round(k, 6).alias(k) for k in t.columns])


# a log with ordinary numbers, a flag and values that are not finite
_LOG = """logrows AS (SELECT event_id, value, CASE WHEN event_id % 50 = 0 THEN 'NaN'::DOUBLE WHEN event_id % 50 = 1 THEN 'Infinity'::DOUBLE ELSE value * 2 END AS loss,
    event_id % 3 = 0 AS ok FROM events), long AS (SELECT 'event_id' AS key, event_id::DOUBLE AS v FROM logrows UNION ALL SELECT 'value', value FROM logrows
    UNION ALL SELECT 'loss', loss FROM logrows UNION ALL SELECT 'ok', ok::INT::DOUBLE FROM logrows)"""


def _log(spark, d):
    odd = (
        F.when(c("event_id") % 50 == 0, F.lit(float("nan")))
        .when(c("event_id") % 50 == 1, F.lit(float("inf")))
        .otherwise(c("value") * 2)
    )
    return b.table(spark, d, "events").select("event_id", "value", odd.alias("loss"), (c("event_id") % 3 == 0).alias("ok"))


@query(
    "A06_log_summary",
    f"""WITH {_LOG} SELECT key, {_STATS.format(std='stddev_pop', q=_q(profile.LOG_QUANTILES))}, (SELECT count(*) FROM logrows) AS rows
    FROM long WHERE isfinite(v) GROUP BY key""",
)
def a06(spark, d):
    return _rounded(profile.log_summary(_log(spark, d)))


@query(
    "A07_log_summary_all_values",
    f"""WITH {_LOG} SELECT key, {_STATS.format(std='stddev_pop', q=_q(profile.SHORT_QUANTILES))}, (SELECT count(*) FROM logrows) AS rows
    FROM long WHERE key <> 'loss' GROUP BY key UNION ALL SELECT 'loss', count(*), 'NaN'::DOUBLE, 'NaN'::DOUBLE, 'NaN'::DOUBLE, 'NaN'::DOUBLE, 'NaN'::DOUBLE, 'NaN'::DOUBLE,
    'NaN'::DOUBLE, (SELECT count(*) FROM logrows) FROM logrows""",
)
def a07(spark, d):
    return _rounded(profile.log_summary(_log(spark, d), finite_only=False))


@query("A08_grade_totals", f"WITH {b.GRADED_SQL} SELECT grade, count(*) AS n FROM graded GROUP BY grade")
def a08(spark, d):
    return grade.grade_totals(b.graded(spark, d))


_KINDS = [
    ("DUPLICATE", "duplicate"), ("STATIC", "static"), ("TIMELAPSE", "timelapse"), ("SCENE_CUT", "scene_cuts"),
    ("CLIPPING", "clipping"), ("LOW_CONFORMANCE", "conformance"),
]
_ISSUES = "issues AS (" + " UNION ALL ".join(
    f"SELECT source, '{k}' AS kind FROM graded WHERE grade = 'FAIL' AND contains(reason, '{w}')" for k, w in _KINDS
) + ")"


@query(
    "A09_source_table",
    f"""WITH {b.GRADED_SQL}, {_ISSUES}, per AS (SELECT source, kind, count(*) AS n FROM issues GROUP BY ALL),
    txt AS (SELECT source, string_agg(kind || ':' || n, ', ' ORDER BY n DESC, kind) AS issues FROM per GROUP BY source)
    SELECT g.source, count(*) AS total, count(*) FILTER (grade = 'PASS') AS pass, count(*) FILTER (grade = 'REVIEW') AS review, count(*) FILTER (grade = 'FAIL') AS fail,
    round(count(*) FILTER (grade = 'FAIL') / count(*)::DOUBLE, 9) AS fail_rate, coalesce(any_value(txt.issues), '-') AS issues
    FROM graded g LEFT JOIN txt ON g.source = txt.source GROUP BY g.source""",
)
def a09(spark, d):
    return grade.source_table(b.graded(spark, d)).withColumn("fail_rate", F.round("fail_rate", 9))


@query("A10_issue_totals", f"WITH {b.GRADED_SQL}, {_ISSUES} SELECT kind AS category, count(*) AS n FROM issues GROUP BY kind")
def a10(spark, d):
    return grade.issue_totals(b.graded(spark, d))


_UNIQ = ["clip_id", "clip_sha256", "first_frame_sha256", "source_video_id", "source_video_url", "caption"]


@query(
    "A11_uniqueness",
    f"WITH {b.RECORDS_SQL} SELECT count(*) AS rows, {', '.join(f'count(DISTINCT {k}) AS {k}_unique' for k in _UNIQ)} FROM records",
)
def a11(spark, d):
    return profile.uniqueness(b.records(spark, d), _UNIQ)


@query(
    "A12_cue_lists",
    f"""WITH {b.RECORDS_SQL}, s AS (SELECT source_video_url AS url, clip_start_sec, CAST(round_even(clip_start_sec, 0) AS BIGINT) AS x FROM records)
    SELECT url AS source_video_url, row_number() OVER (PARTITION BY url ORDER BY clip_start_sec) AS position, CASE WHEN x < 60 THEN x::VARCHAR ELSE printf('%d:%02d', x // 60, x % 60) END AS cue FROM s""",
)
def a12(spark, d):
    return profile.cue_lists(b.records(spark, d), "source_video_url", "clip_start_sec")


_DESC = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


@query(
    "A13_describe",
    f"""WITH {b.PROMPTS_SQL}, long AS (SELECT 'doc_id' AS key, doc_id::DOUBLE AS v FROM prompts UNION ALL SELECT 'n_chars', n_chars::DOUBLE FROM prompts
      UNION ALL SELECT 'caption_length', length(prompt)::DOUBLE FROM prompts)
    SELECT key, {_STATS.format(std='stddev_samp', q=_q(_DESC))} FROM long GROUP BY key""",
)
def a13(spark, d):
    from clipwarden.functions.text import caption_length

    t = b.prompts(spark, d).withColumn("caption_length", caption_length(c("prompt")))
    return _rounded(profile.describe(t, ["doc_id", "n_chars", "caption_length"]))


@query(
    "A14_modes",
    f"""WITH {b.RECORDS_SQL}, long AS (SELECT unnest(['width', 'height', 'fps', 'num_frames', 'clip_start_sec']) AS key,
      unnest([width::DOUBLE, height::DOUBLE, fps, num_frames::DOUBLE, clip_start_sec]) AS v FROM records), k AS (SELECT key, v, count(*) AS n FROM long GROUP BY ALL)
    SELECT key, count(*) AS distinct_values, max_by(v, (n, -v)) AS mode_value, max(n) AS mode_rows FROM k GROUP BY key""",
)
def a14(spark, d):
    return profile.modes(b.records(spark, d), ["width", "height", "fps", "num_frames", "clip_start_sec"])


_PROFILE = [("o_orderkey", "bigint"), ("clip_id", "string"), ("width", "bigint"), ("fps", "double"), ("caption", "string")]


@query(
    "A15_schema_profile",
    f"WITH {b.RECORDS_SQL} "
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{k}' AS column, '{t}' AS type, count({k}) AS non_null FROM records" for i, (k, t) in enumerate(_PROFILE)
    ),
)
def a15(spark, d):
    return profile.schema_profile(b.records(spark, d).select(*[k for k, _ in _PROFILE]))


_AGREE = ["clip_sha256", "source_video_id", "clip_start_sec", "width", "caption"]


@query(
    "A16_field_agreement",
    f"WITH {b.RECORDS2_SQL}, j AS (SELECT o.*, t.* FROM (SELECT clip_id, "
    + ", ".join(f"{k} AS {k}_o" for k in _AGREE)
    + " FROM records) o FULL JOIN (SELECT clip_id AS id2, "
    + ", ".join(f"{k} AS {k}_t" for k in _AGREE)
    + " FROM records2) t ON o.clip_id = t.id2) "
    + " UNION ALL ".join(
        f"SELECT '{k}' AS field, count(*) FILTER ({k}_o IS NOT DISTINCT FROM {k}_t) AS same, count(*) FILTER ({k}_o IS DISTINCT FROM {k}_t) AS different FROM j"
        for k in _AGREE
    ),
)
def a16(spark, d):
    t = compare.compare_versions(b.records(spark, d), b.records_v2(spark, d), fields=_AGREE)
    return compare.field_agreement(t, _AGREE)


#: Compared by the source of a clip, which many clips have.
_AGREE_BY_SOURCE = ["clip_id", "clip_start_sec", "width", "fps", "caption"]


@query(
    "A16_agreement_by_source",
    f"WITH {b.RECORDS2_SQL}, j AS (SELECT o.*, t.* FROM (SELECT source_video_id AS id1, "
    + ", ".join(f"{k} AS {k}_o" for k in _AGREE_BY_SOURCE)
    + " FROM records) o FULL JOIN (SELECT source_video_id AS id2, "
    + ", ".join(f"{k} AS {k}_t" for k in _AGREE_BY_SOURCE)
    + " FROM records2) t ON o.id1 = t.id2) "
    + " UNION ALL ".join(
        f"SELECT '{k}' AS field, count(*) FILTER ({k}_o IS NOT DISTINCT FROM {k}_t) AS same, count(*) FILTER ({k}_o IS DISTINCT FROM {k}_t) AS different FROM j"
        for k in _AGREE_BY_SOURCE
    ),
)
def a16c(spark, d):
    return compare.versions_agreement(b.records(spark, d), b.records_v2(spark, d), "source_video_id", _AGREE_BY_SOURCE)


@query(
    "A16_size_totals",
    """SELECT sum(o_orderkey % 100)::BIGINT AS total_orig, sum(CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 90 END)::BIGINT AS total_target,
    round(sum(CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 90 END) / sum(o_orderkey % 100)::DOUBLE * 100e0, 6) AS size_percent FROM orders""",
)
def a16b(spark, d):
    t = b.table(spark, d, "orders").select(
        (c("o_orderkey") % 100).alias("size_orig"), F.when(c("o_orderkey") % 13 != 0, c("o_orderkey") % 90).alias("size_target")
    )
    return compare.size_totals(t, "size_orig", "size_target").withColumn("size_percent", F.round("size_percent", 6))


@query("A17_overlap_index", f"WITH {b.STARTS_SQL} SELECT count(DISTINCT key) AS keys, count(start) AS positions FROM starts")
def a17(spark, d):
    return joins.overlap_index(b.starts(spark, d), "key", "start")


@query(
    "A20_validation_losses",
    f"""WITH {b.RUNLOG_SQL} SELECT step, coalesce(round(avg(loss) FILTER (step <> 1), 9), 'NaN'::DOUBLE) AS val_loss,
    coalesce(round(stddev_pop(loss) FILTER (step <> 1), 9), 'NaN'::DOUBLE) AS val_loss_std, count(loss) FILTER (step <> 1) AS val_batches FROM runlog GROUP BY step""",
)
def a20(spark, d):
    rows = b.runlog(spark, d).withColumn("loss", F.when(c("step") != 1, c("loss")))
    t = profile.validation_losses(rows, ["step"], "loss")
    return t.select("step", F.round("val_loss", 9).alias("val_loss"), F.round("val_loss_std", 9).alias("val_loss_std"), "val_batches")


@query(
    "A21_dataset_digest",
    """WITH r AS (SELECT sha256(coalesce(doc_id::VARCHAR, chr(0)) || chr(31) || coalesce(lang, chr(0)) || chr(31) || coalesce(text, chr(0))) AS h FROM documents),
    s AS (SELECT count(*) AS n, sum(('0x' || substring(h, 1, 15))::BIGINT)::VARCHAR AS a, sum(('0x' || substring(h, 16, 15))::BIGINT)::VARCHAR AS b FROM r)
    SELECT n AS record_count, sha256(n || ':' || a || ':' || b) AS dataset_sha256 FROM s""",
)
def a21(spark, d):
    return profile.dataset_digest(b.table(spark, d, "documents").select("doc_id", "lang", "text"))


@query(
    "A22_outcome_counts",
    "SELECT count(*) FILTER (doc_id % 7 <> 0) AS rows_written, count(*) FILTER (doc_id % 7 = 0) AS failures FROM documents",
)
def a22(spark, d):
    t = b.table(spark, d, "documents").select((c("doc_id") % 7 != 0).alias("ok"))
    return profile.outcome_counts(t, "ok")
