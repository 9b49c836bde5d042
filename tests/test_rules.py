"""Golden cases of scalar rules, grading, screening, linting and checks."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row
from pyspark.sql import functions as F

from clipwarden.functions import numbers, paths, scores, text, urls
from clipwarden.operators import compare, dedup, grade, lint, prescreen, profile, select, validate
from clipwarden.operators.latest import edge_rows
from clipwarden.sources import manifests
from clipwarden.spec import GradeThresholds, LintConfig


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "args, want",
    [((1280, 704, 121, 24.0), 1.0), ((1280, 704, 121, 0.0), 0.958333), ((640, 704, 121, 24.0), 0.765152)],
)
def test_conformance(spark, args, want):
    w, h, n, fps = args
    got = one(spark, scores.conformance(F.lit(w), F.lit(h), F.lit(n), F.lit(fps), F.lit(0.0)))
    assert got == pytest.approx(want, abs=1e-6)


def clip(**kw):
    base = dict(
        conformance_score=1.0, duplicate_frame_ratio=0.0, timelapse_score=0.0, temporal_diff_mean=0.01,
        scene_cut_count=0, black_pixel_ratio=0.0, white_pixel_ratio=0.0,
    )
    return Row(**{**base, **kw})


@pytest.mark.parametrize(
    "kw, want",
    [
        ({"duplicate_frame_ratio": 0.04}, ("REVIEW", "minor flags")),
        (
            {"scene_cut_count": 1, "duplicate_frame_ratio": 0.06, "temporal_diff_mean": 0.004},
            ("FAIL", "scene_cuts=1; duplicates=6.00%; static_mean_delta=0.0040"),
        ),
        ({"duplicate_frame_ratio": 0.05}, ("REVIEW", "minor flags")),
        ({}, ("PASS", "passed all checks")),
        ({"black_pixel_ratio": 0.1, "white_pixel_ratio": 0.1}, ("FAIL", "clipping=20.00%")),
        ({"conformance_score": 0.4996, "timelapse_score": 0.625}, ("FAIL", "timelapse=0.62; conformance=0.500")),
    ],
)
def test_grade(spark, kw, want):
    r = grade.grade_clips(spark.createDataFrame([clip(**kw)])).first()
    assert (r["grade"], r["reason"]) == want


def test_grade_limits_can_be_changed(spark):
    df = spark.createDataFrame([clip(scene_cut_count=2)])
    assert grade.grade_clips(df, GradeThresholds(scene_cut_max=2)).first()["grade"] == "PASS"


def test_dataset_grade_defaults(spark):
    assert grade.grade_dataset(spark.range(1)).first()["dataset_grade"] == "FAIL"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(0, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_fixed_text_matches_exact_rounding(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    v = F.col("v")
    for r in df.select("v", numbers.fixed_text(v, 2).alias("a"), numbers.fixed_text(v, 4).alias("b")).collect():
        assert (r["a"], r["b"]) == (f"{r['v']:.2f}", f"{r['v']:.4f}")


@pytest.mark.parametrize("v", [0.125, 0.375, 1.005, 2.675, 1.115, 0.045, 8.345, 1e-9, 99.995])
def test_fixed_text_near_ties(spark, v):
    assert one(spark, numbers.fixed_text(F.lit(v), 2)) == f"{v:.2f}"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 5000), st.integers(1, 5000), st.integers(0, 500), st.floats(0, 120), st.floats(0, 1)), min_size=5, max_size=30))
def test_conformance_is_a_share(spark, rows):
    df = spark.createDataFrame(rows, "w int, h int, n int, f double, d double")
    c = scores.conformance(F.col("w"), F.col("h"), F.col("n"), F.col("f"), F.col("d"))
    assert all(-1e-12 <= r[0] <= 1 + 1e-12 for r in df.select(c).collect())


def test_canonical_source_key(spark):
    watch = "https://www.youtube.com/watch?v=ABC"
    cases = {
        "https://youtu.be/ABC?t=1": watch,
        "https://m.youtube.com/shorts/ABC": watch,
        "https://WWW.youtube.com/watch?v=ABC&t=2": watch,
        " https://x.org/a ": "https://x.org/a",
        "https://youtube.com/watch?v=a%2Bb": "https://www.youtube.com/watch?v=a+b",
        "https://youtu.be/": "https://youtu.be/",
        "not a url": "not a url",
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    got = {r["u"]: r["k"] for r in df.select("u", urls.canonical_source_key(F.col("u")).alias("k")).collect()}
    assert got == cases


def test_timestamps_and_plans(spark):
    assert [one(spark, text.cue_text(F.lit(float(s)))) for s in (59, 61, 3661)] == ["59", "1:01", "1:01:01"]
    assert one(spark, text.clock_text(F.lit(59))) == "0:59"
    assert one(spark, scores.keyframe_plan(F.lit(121), 4)) == [0, 40, 80, 120]
    assert one(spark, scores.keyframe_plan(F.lit(122), 3)) == [0, 60, 121]
    assert one(spark, scores.keyframe_plan(F.lit(122), 1)) == [0]
    assert one(spark, scores.keyframe_plan(F.lit(122), 0)) == []
    with pytest.raises(Exception, match="no frames"):
        one(spark, scores.uniform_frames(F.lit(0), 4))


def test_timelapse_golden(spark):
    assert one(spark, scores.timelapse(F.lit(0.0), F.lit(0.5), F.lit(0.15), F.lit(0.15))) == pytest.approx(0.35)


def test_clean_id(spark):
    df = spark.createDataFrame([("a b/c",), (None,), ("__",)], "v string")
    assert [r[0] for r in df.select(paths.clean_id(F.col("v"), F.lit("fb"))).collect()] == ["a_b_c", "fb", "fb"]


def test_primary_category(spark):
    df = spark.createDataFrame([("passed all checks",), ("minor flags",), ("scene_cuts=1; duplicates=6.00%",)], "r string")
    assert [r[0] for r in df.select(text.primary_category(F.col("r"))).collect()] == ["passed all checks", "minor flags", "scene_cuts"]


def test_strict_clip_id_fails(spark):
    with pytest.raises(Exception, match="cannot parse clip_id"):
        one(spark, paths.strict(paths.clip_video_id(F.lit("nope")), F.lit("nope"), "clip_id"))


def info(**kw):
    base = dict(url="u", title="", description="", duration=60.0, width=1280, height=720, fps=30.0, error=None)
    return {**base, **kw}


def test_score_metadata_golden(spark):
    rows = [
        info(title="Gimbal hiking", duration=130.0, width=1920, height=1080, fps=24.0),
        info(duration=10.0, width=640, height=360, fps=15.0),
        info(title="frozen lake"),
        info(error="boom"),
        info(description="Best Of 2020"),
    ]
    schema = "url string, title string, description string, duration double, width int, height int, fps double, error string"
    out = prescreen.recommend_by_metadata(prescreen.score_metadata(spark.createDataFrame(rows, schema))).collect()
    assert out[0]["metadata_score"] == 1.0 and out[0]["recommendation"] == "KEEP"
    assert out[1]["metadata_score"] == pytest.approx(-0.3) and out[1]["recommendation"] == "REJECT"
    assert out[2]["reason"] == "reject_title:zen"  # substring of "frozen"
    assert out[3]["reason"] == "metadata_error:boom"
    assert out[4]["reason"] == "reject_desc:best of"


def test_best_file(spark):
    files = "array<struct<height:int,width:int,fps:double,link:string,file_type:string>>"
    df = spark.createDataFrame([([(2160, 3840, None, "a", ""), (2160, 3840, 30.0, "b", ""), (1080, 1920, 60.0, "c", "")],)], f"f {files}")
    assert df.select(select.best_file(F.col("f"), 2160, 24).alias("b")).first()["b"]["link"] == "b"
    assert df.select(select.best_file(F.col("f"), 9000, 24).alias("b")).first()["b"] is None


def lint_lines(spark, lines):
    raw = spark.createDataFrame(list(enumerate(lines, 1)), "line bigint, raw string")
    classified = manifests.classify_lines(raw)
    return manifests.parsed_rows(classified), manifests.read_issues(classified)


NO_STATS = "path string, width int, height int, frames int, fps double, duplicate_frame_ratio double, decode_error string"


def test_lint_golden(spark):
    rows, issues = lint_lines(spark, ["{bad", "[1]", '{"video":"a.mp4","prompt":"one two"}', "  "])
    none = spark.createDataFrame([], NO_STATS)
    got = lint.lint_manifest(rows, issues, none.select("path"), none, "/d")
    assert {(r["code"], r["line"]) for r in got.collect()} == {
        ("MANIFEST_BAD_JSON", 1), ("MANIFEST_ROW_NOT_OBJECT", 2), ("MISSING_ID", 3), ("PROMPT_TOO_SHORT", 3), ("VIDEO_NOT_FOUND", 3),
    }
    with pytest.raises(RuntimeError):
        lint.require_ok(got)
    lint.require_ok(got, allow_errors=True)


def test_lint_counts_stopped_rows_and_empty(spark):
    row = '{"id":"x","video":"a.mp4","prompt":"p"}'
    rows, issues = lint_lines(spark, [row, '{"id":"x","prompt":"p"}', row])
    none = spark.createDataFrame([], NO_STATS)
    got = lint.lint_manifest(rows, issues, none.select("path"), none, "/d").filter("code = 'DUPLICATE_ID'").first()
    assert (got["sample_id"], got["value"], got["message"]) == ("x", "3", "Sample id appears 3 times: x")
    rows, issues = lint_lines(spark, ["{bad"])
    codes = [r["code"] for r in lint.lint_manifest(rows, issues, none.select("path"), none, "/d").collect()]
    assert sorted(codes) == ["MANIFEST_BAD_JSON", "MANIFEST_EMPTY"]


def test_lint_accepts_bare_nan(spark):
    rows, issues = lint_lines(spark, ['{"id":"a","video":"v.mp4","prompt":"p","score":NaN,"w":[Infinity]}'])
    assert rows.count() == 1 and issues.count() == 0


def test_lint_resize_severity(spark):
    rows, issues = lint_lines(spark, ['{"id":"a","video":"/v.mp4","prompt":"a b c d e f"}'])
    stats = spark.createDataFrame([("/v.mp4", 640, 704, 121, 24.0, 0.0, None)], NO_STATS)
    got = lint.lint_manifest(rows, issues, stats.select("path"), stats, "/d", LintConfig(allow_resize=False))
    found = {r["code"]: (r["severity"], r["message"], r["value"]) for r in got.collect()}
    assert found["WIDTH_MISMATCH"] == ("ERROR", "a width is 640, expected 1280.", "640")
    assert found["ASPECT_RATIO_MISMATCH"][2] == "0.9091"


def test_spec_violations(spark):
    df = spark.createDataFrame([(1280, 700, 25.0, 121, 5.0)], "width int, height int, fps double, num_frames int, duration_sec double")
    r = validate.spec_violations(df).first()
    assert (r["violations"], r["rows_violating"]) == (2, 1)


def test_schema_check(spark):
    found = {(r["kind"], r["column"]) for r in validate.schema_check(spark.range(1), ["id", "x"]).collect() if r["kind"] != "present"}
    assert found == {("missing", "x")}


def test_field_equal(spark):
    df = spark.createDataFrame([("NaN", "NaN"), ("5", "5.0"), ("a", "b"), (None, "1"), ("x", "x")], "a string, b string")
    got = [r[0] for r in df.select(numbers.field_equal(F.col("a"), F.col("b"))).collect()]
    assert got == [True, True, False, False, True]


def test_key_stats_golden(spark):
    df = spark.createDataFrame([(1.0, True), (3.0, None), (math.nan, None)], "x double, ok boolean")
    got = {r["key"]: r for r in profile.log_summary(df).collect()}
    assert (got["x"]["rows"], got["x"]["mean"], got["x"]["std"], got["ok"]["mean"]) == (3, 2.0, 1.0, 1.0)
    every = {r["key"]: r for r in profile.log_summary(df, finite_only=False).collect()}
    assert math.isnan(every["x"]["min"]) and math.isnan(every["x"]["p50"])


def test_modes_smallest_wins(spark):
    df = spark.createDataFrame([(2,), (1,), (2,), (1,), (3,)], "w int")
    r = profile.modes(df, ["w"]).first()
    assert (r["distinct_values"], r["mode_value"]) == (3, 1.0)


def test_cue_lists_are_rows(spark):
    df = spark.range(25).select(F.lit("u").alias("url"), F.col("id").cast("double").alias("s"))
    cues = profile.cue_lists(df, "url", "s", partitions=3).orderBy("position").collect()
    assert [(r["position"], r["cue"]) for r in cues] == [(i + 1, str(i)) for i in range(25)]


def test_late_decode_failures_are_marked_not_dropped(spark):
    from clipwarden.operators import lint

    issues = spark.createDataFrame([("ERROR", "VIDEO_DECODE_FAILED", i) for i in range(40)], "severity string, code string, line bigint")
    full = issues.select(*[F.col(n) if n in issues.columns else F.lit(None).cast("string").alias(n) for n in lint.ISSUE_COLUMNS])
    got = lint.mark_after_stop(full, issues.select("line"), 30).collect()
    assert len(got) == 41 and sum(r["after_stop"] for r in got) == 10
    assert len(lint.mark_after_stop(full, issues.select("line"), 41).collect()) == 40


@pytest.mark.parametrize("digits", [2, 3, 4])
def test_fixed_text_of_all_sizes(spark, digits):
    values = [math.nan, math.inf, -math.inf, 0.0, -0.125, 0.5, 99999999999.995, 1e11 + 0.005, -123456789012.345, 4.6e14 + 0.0625, 1e15 + 0.125,
              9007199254740993.0, 1e15, 1.5e18, 9.1e18, 1e22]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r["i"]: r["t"] for r in df.select("i", numbers.fixed_text(F.col("v"), digits).alias("t")).collect()}
    assert [got[i] for i in range(len(values))] == [f"{v:.{digits}f}" for v in values]


def test_type_suffixes_are_no_numbers(spark):
    texts = ["5d", "1f", "5D", "0x1p3", "5", " 5 ", "-1.5e3", ".5", "5.", "inf", "Infinity", "nan", "", "abc"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["t"]: r["n"] for r in df.select("t", numbers.number_of(F.col("t")).alias("n")).collect()}
    assert [got[t] for t in texts[:4]] == [None] * 4 and got[""] is None and got["abc"] is None
    assert (got["5"], got[" 5 "], got["-1.5e3"], got[".5"], got["5."], got["inf"], got["Infinity"]) == (5, 5, -1500, 0.5, 5, math.inf, math.inf)
    pair = spark.createDataFrame([("5d", "5"), ("5", "5.0")], "a string, b string")
    assert [r["e"] for r in pair.select(numbers.field_equal(F.col("a"), F.col("b")).alias("e")).collect()] == [False, True]


def test_nan_ratio_is_for_review(spark):
    names = ["scene_cut_count", "duplicate_frame_ratio", "timelapse_score", "temporal_diff_mean", "black_pixel_ratio", "white_pixel_ratio", "conformance_score"]
    rows = [(0, math.nan, 0.0, 0.1, 0.0, 0.0, 0.95), (0, 0.0, math.nan, 0.1, math.nan, 0.0, 0.95), (0, 0.0, 0.0, 0.1, 0.0, 0.0, math.nan)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'int' if n == 'scene_cut_count' else 'double'}" for n in names))
    assert [(r["grade"], r["reason"]) for r in grade.grade_clips(df).collect()] == [("REVIEW", "minor flags")] * 3
    odd = spark.createDataFrame([(2, math.inf, 0.0, 0.1, 0.0, 0.0, 0.95)], df.schema)
    assert grade.grade_clips(odd).first()["reason"] == "scene_cuts=2; duplicates=inf%"


def test_scratch_scope_leaves_nothing(spark):
    import os

    from clipwarden.session import cut_lineage, scratch_path, scratch_scope, shared_dir

    shared_dir(spark)
    before = spark.sparkContext.getCheckpointDir()
    with scratch_scope(spark) as folder:
        path = scratch_path(spark, "rows")
        spark.range(3).write.parquet(path)
        assert cut_lineage(spark.read.parquet(path)).count() == 3 and path.startswith(folder)
    local = folder.removeprefix("file:")
    assert not os.path.exists(local)
    assert spark.sparkContext.getCheckpointDir().rsplit("/", 1)[0] == before.rsplit("/", 1)[0]
    assert cut_lineage(spark.range(2)).count() == 2


def test_ids_beyond_the_padding_are_whole(spark):
    assert spark.range(1).select(paths.sample_fallback(F.lit(1_234_567)).alias("v")).first()["v"] == "sample_1234567"


ONE = "clip_id string, source_video_id string, clip_start_sec double, source_frames int, dup_ratio double"


def test_one_per_source_golden(spark):
    df = spark.createDataFrame([("a", "s", 0.0, 119, 0.0), ("b", "s", 5.0, 121, 0.01), ("c", "s", 9.0, 121, 0.01), ("d", "t", 0.0, 121, 0.5)], ONE)
    got = {r["clip_id"]: (r["decision"], r["reason"]) for r in dedup.one_per_source(df).collect()}
    assert got == {
        "a": ("removed", "frames=119<121"), "b": ("kept", "kept"), "c": ("removed", "later_from_same_source"),
        "d": ("kept", "no_valid_candidate_kept_earliest"),
    }


def test_one_per_source_compat(spark):
    df = spark.createDataFrame([("d", "t", 0.0, 121, 0.5), ("e", "t", 1.0, None, 0.5), ("f", "t", 2.0, 50, 0.0)], ONE)
    got = sorted((r["clip_id"], r["decision"], r["reason"]) for r in dedup.one_per_source(df, compat=True).collect())
    assert got == [
        ("d", "kept", "no_valid_candidate_kept_earliest"), ("d", "removed", "dup_ratio=0.500>0.03"), ("f", "removed", "frames=50<121"),
    ]


def test_missing_quality_defaults(spark):
    from clipwarden.operators.joins import attach_measures

    quality = spark.createDataFrame([], "name string, grade string, duplicate_frame_ratio double, source_frames int")
    rows = spark.createDataFrame([("c1", "v/c1.mp4")], "id string, video string")
    assert grade.filter_clips(rows, quality).count() == 1
    r = attach_measures(rows.withColumnRenamed("id", "clip_id"), quality).first()
    assert (r["source_frames"], r["dup_ratio"]) == (0, 1.0)


def test_altered_copies_of_a_stock_caption_stay_linear(spark):
    rows = [(f"h{i % 7}", "stock", float(i % 3)) for i in range(60)] + [("x", "", 0.0), (None, "only", 1.0)]
    df = spark.createDataFrame(rows, "clip_sha256 string, caption string, clip_start_sec double")
    got = dedup.altered_copies(df, df, ["caption"], ["clip_sha256", "clip_start_sec"]).collect()
    assert len(got) == 21 and {r["altered"] + r["rows"] for r in got} == {60}


def test_copies_do_not_multiply_in_comparisons(spark):
    df = spark.createDataFrame([("a", 1)] * 50, "clip_id string, width int")
    t = compare.compare_versions(df, df, fields=["width"])
    assert t.count() == 1 and t.first()["pairs"] == 2500
    assert compare.field_agreement(t, ["width"]).first()["same"] == 2500


def test_edge_rows_against_a_plain_loop(spark):
    """Nulls, ties on the leading column, a hot key, both ends, and either way."""
    rows = [(k, o, str(t), f"{k}{o}{t}") for k in ("a", "b", None) for o in (None, 1, 3, 3) for t in (2, 10)]
    rows += [("hot", i % 7, str(i), f"h{i}") for i in range(500)] + [("void", None, None, "v")]
    df = spark.createDataFrame(rows, "k string, o long, t string, p string").repartition(7)
    low = lambda r: ((r[1] is not None, r[1] or 0), (r[2] is not None, r[2] or ""))
    for last in (True, False):
        expected = {}
        for r in rows:
            best = expected.get(r[0])
            if best is None or (low(r) > low(best) if last else low(r) < low(best)):
                expected[r[0]] = r
        for narrow in (True, False):
            got = edge_rows(df, ["k"], ["o", "t"], last, narrow).collect()
            assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected.values()))
    assert edge_rows(df.limit(0), ["k"], ["o", "t"]).count() == 0


def test_edge_rows_needs_no_sort_aggregate(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS o", "cast(id AS string) AS p")
    plan = edge_rows(df, ["k"], ["o"])._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan and "WindowGroupLimit" in plan


def test_agreement_of_many_versions_against_pairs(spark):
    """Null keys, keys on one side only, repeated keys, missing values and numbers written as text."""
    a = [("k", "1", 1.0)] * 3 + [("k", "1.0", None), ("k", None, float("nan")), (None, "1", 1.0), ("a", None, 2.0), ("a", "x", None)]
    b = [("k", "1", 1.0)] * 2 + [("k", None, None), ("k", "y", 3.0), (None, "1", None), ("b", "NaN", 2.0)]
    schema = "clip_id string, x string, y double"
    left, right = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    fields = ["x", "y"]

    def told(df):
        return sorted((r["field"], r["same"], r["different"]) for r in df.collect())

    want = told(compare.field_agreement(compare.compare_versions(left, right, fields=fields), fields))
    assert told(compare.versions_agreement(left, right, fields=fields)) == want
    # two thousand versions of one key: four million pairs that are never formed
    many = spark.range(2000).select(F.lit("hot").alias("clip_id"), (F.col("id") % 2).cast("string").alias("x"))
    assert told(compare.versions_agreement(many, many, fields=["x"])) == [("x", 2_000_000, 2_000_000)]
