"""Queries of filters, rule sets and the linter (R), and of source screening."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipwarden.functions import paths
from clipwarden.operators import grade, lint, prescreen, select, validate
from clipwarden.operators import records as rec
from clipwarden.plans import bindings as b
from clipwarden.plans.registry import query
from clipwarden.session import scratch_path
from clipwarden.sources import manifests
from clipwarden.spec import CLIP_COLUMNS, KEEP_KEYWORDS, REJECT_KEYWORDS, LintConfig

c = F.col
ROW = ", ".join(b.ROW_ORDER)


@query("R01_grade_clip", f"WITH {b.GRADED_SQL} SELECT {ROW}, grade, reason FROM graded")
def r01(spark, d):
    return b.graded(spark, d).select(*b.ROW_ORDER, "grade", "reason")


@query(
    "R02_grade_dataset",
    f"""WITH {b.SCORED_SQL}, m AS (SELECT source, avg(conformance_score) AS cf, avg(duplicate_frame_ratio) AS du,
      avg(black_pixel_ratio) AS bl, avg(white_pixel_ratio) AS wh FROM scored GROUP BY source)
    SELECT source, CASE WHEN cf >= 0.9e0 AND du < 0.03e0 AND bl + wh < 0.08e0 THEN 'PASS'
      WHEN cf >= 0.75e0 AND du < 0.10e0 AND bl + wh < 0.15e0 THEN 'REVIEW' ELSE 'FAIL' END AS dataset_grade FROM m""",
)
def r02(spark, d):
    m = grade.score_clips(b.clips(spark, d)).groupBy("source").agg(
        *[F.avg(k).alias(k) for k in ("conformance_score", "duplicate_frame_ratio", "black_pixel_ratio", "white_pixel_ratio")]
    )
    return grade.grade_dataset(m).select("source", "dataset_grade")


# --- manifest lint ---------------------------------------------------------

# documents as manifest lines: broken JSON, non-objects, missing ids, blank videos and prompts
_LINES = """raw AS (SELECT doc_id, doc_id + 1 AS line,
    CASE WHEN doc_id % 40 = 1 THEN 'bad' WHEN doc_id % 40 = 2 THEN 'list' WHEN doc_id % 40 = 3 THEN 'blank' ELSE 'row' END AS kind,
    CASE WHEN doc_id % 10 = 4 THEN NULL WHEN doc_id % 10 = 5 THEN ' ' ELSE 'doc_' || (doc_id % 900) END AS id,
    CASE WHEN doc_id % 12 = 6 THEN '' WHEN doc_id % 12 = 7 THEN NULL ELSE source || '/' || (doc_id % 700)
      || CASE WHEN doc_id % 9 = 0 THEN '.gif' ELSE '.mp4' END END AS video,
    CASE WHEN doc_id % 11 = 0 THEN ' ' WHEN doc_id % 11 = 1 THEN 'only three words' ELSE 'shot of ' || text END AS prompt
  FROM documents), rowz AS (SELECT *, '/data/' || video AS path,
    coalesce(nullif(id, ''), CASE WHEN video IS NULL THEN 'row_' || line WHEN video = '' THEN ''
      ELSE regexp_replace(regexp_extract(video, '([^/]+)$', 1), '\\.[^.]+$', '') END) AS sample_id
  FROM raw WHERE kind = 'row'), stat AS (SELECT doc_id, '/data/' || source || '/' || doc_id || CASE WHEN doc_id % 9 = 0 THEN '.gif' ELSE '.mp4' END AS path,
    doc_id % 4 <> 3 AS found, CASE WHEN doc_id % 37 = 5 THEN 'moov atom not found' END AS decode_error,
    CASE WHEN doc_id % 29 = 0 THEN 0 ELSE 119 + doc_id % 5 END AS frames, 1280 - 64 * (doc_id % 3) AS width, 704 - 16 * (doc_id % 2) AS height,
    CASE WHEN doc_id % 8 = 0 THEN 0e0 ELSE 23e0 + (doc_id % 5) * 0.5e0 END AS fps, (doc_id % 20) / 100e0 AS dup FROM documents)"""


def manifest_lines(spark, d):
    """(doc_id, value): the JSON text per document."""
    n = c("doc_id")
    no_id = F.lit(None).cast("string")
    body = F.to_json(
        F.struct(
            F.when(n % 10 == 4, no_id).when(n % 10 == 5, " ").otherwise(F.concat(F.lit("doc_"), (n % 900).cast("string"))).alias("id"),
            F.when(n % 12 == 6, "")
            .when(n % 12 == 7, no_id)
            .otherwise(F.concat(c("source"), F.lit("/"), (n % 700).cast("string"), F.when(n % 9 == 0, ".gif").otherwise(".mp4")))
            .alias("video"),
            F.when(n % 11 == 0, " ").when(n % 11 == 1, "only three words").otherwise(F.concat(F.lit("shot of "), c("text"))).alias("prompt"),
        )
    )
    value = F.when(n % 40 == 1, "{bad").when(n % 40 == 2, "[1]").when(n % 40 == 3, " ").otherwise(body)
    return b.table(spark, d, "documents").select("doc_id", value.alias("value"))


def media_stats(spark, d):
    n = c("doc_id")
    path = F.concat(F.lit("/data/"), c("source"), F.lit("/"), n.cast("string"), F.when(n % 9 == 0, ".gif").otherwise(".mp4"))
    return b.table(spark, d, "documents").filter(n % 4 != 3).select(
        path.alias("path"),
        F.when(n % 37 == 5, "moov atom not found").alias("decode_error"),
        F.when(n % 29 == 0, 0).otherwise(119 + n % 5).alias("frames"),
        (1280 - 64 * (n % 3)).alias("width"),
        (704 - 16 * (n % 2)).alias("height"),
        F.when(n % 8 == 0, F.lit(0.0)).otherwise(F.lit(23.0) + (n % 5) * F.lit(0.5)).alias("fps"),
        ((n % 20) / F.lit(100.0)).alias("duplicate_frame_ratio"),
    )


def written_manifest(spark, d):
    path = scratch_path(spark, "manifest")
    lines = manifest_lines(spark, d)
    # sorted by range, so that the line numbers follow doc_id across the part files
    lines.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("value").write.text(path)
    return path


def manifest_issues(spark, d, cfg=LintConfig()):
    lines = manifest_lines(spark, d).select((c("doc_id") + 1).alias("line"), c("value").alias("raw"))
    rows, read_issues = manifests.scan_manifest(lines)
    stats = media_stats(spark, d)
    return lint.lint_manifest(rows, read_issues, stats.select("path"), stats, "/data", cfg)


def _lint_sql() -> str:
    return f"""WITH {_LINES}, seen AS (SELECT r.line, r.id, r.video, r.prompt, r.path, r.sample_id, s.decode_error, s.frames, s.width, s.height, s.fps, s.dup,
      coalesce(s.found, false) AS file_found, coalesce(trim(r.video), '') <> '' AS hv FROM rowz r LEFT JOIN (SELECT * FROM stat WHERE found) s ON r.path = s.path),
    ok AS (SELECT *, abs(width::DOUBLE / height - 1280e0 / 704e0) AS aspect FROM seen WHERE hv AND file_found AND decode_error IS NULL AND frames > 0)
    SELECT 'ERROR' AS severity, 'MANIFEST_BAD_JSON' AS code, line, NULL AS sample_id, '{{bad' AS value FROM raw WHERE kind = 'bad'
    UNION ALL SELECT 'ERROR', 'MANIFEST_ROW_NOT_OBJECT', line, NULL, NULL FROM raw WHERE kind = 'list'
    UNION ALL SELECT 'WARN', 'MISSING_ID', line, sample_id, NULL FROM seen WHERE id IS NULL OR trim(id) = ''
    UNION ALL SELECT 'ERROR', 'MISSING_VIDEO_FIELD', line, sample_id, NULL FROM seen WHERE NOT hv
    UNION ALL SELECT 'ERROR', 'MISSING_PROMPT_FIELD', line, sample_id, NULL FROM seen WHERE hv AND trim(prompt) = ''
    UNION ALL SELECT 'WARN', 'PROMPT_TOO_SHORT', line, sample_id, prompt FROM seen WHERE hv AND trim(prompt) <> '' AND len(regexp_extract_all(prompt, '\\S+')) < 6
    UNION ALL SELECT 'WARN', 'UNUSUAL_VIDEO_EXTENSION', line, sample_id, NULL FROM seen WHERE hv AND path LIKE '%.gif'
    UNION ALL SELECT 'ERROR', 'VIDEO_NOT_FOUND', line, sample_id, NULL FROM seen WHERE hv AND NOT file_found
    UNION ALL SELECT 'ERROR', 'VIDEO_DECODE_FAILED', line, sample_id, decode_error FROM seen WHERE hv AND file_found AND decode_error IS NOT NULL
    UNION ALL SELECT 'ERROR', 'VIDEO_EMPTY', line, sample_id, NULL FROM seen WHERE hv AND file_found AND decode_error IS NULL AND frames = 0
    UNION ALL SELECT 'WARN', 'WIDTH_MISMATCH', line, sample_id, width::VARCHAR FROM ok WHERE width <> 1280
    UNION ALL SELECT 'WARN', 'HEIGHT_MISMATCH', line, sample_id, height::VARCHAR FROM ok WHERE height <> 704
    UNION ALL SELECT 'WARN', 'ASPECT_RATIO_MISMATCH', line, sample_id, printf('%.4f', aspect)::DOUBLE::VARCHAR FROM ok WHERE aspect > 0.02e0
    UNION ALL SELECT 'ERROR', 'NOT_ENOUGH_FRAMES', line, sample_id, frames::VARCHAR FROM ok WHERE frames < 121
    UNION ALL SELECT 'WARN', 'FRAME_COUNT_MISMATCH', line, sample_id, frames::VARCHAR FROM ok WHERE frames > 121
    UNION ALL SELECT 'WARN', 'FPS_UNKNOWN', line, sample_id, NULL FROM ok WHERE fps <= 0
    UNION ALL SELECT 'WARN', 'FPS_MISMATCH', line, sample_id, fps::VARCHAR FROM ok WHERE fps > 0 AND abs(fps - 24e0) > 0.75e0
    UNION ALL SELECT 'WARN', 'HIGH_DUPLICATE_FRAME_RATIO', line, sample_id, dup::VARCHAR FROM ok WHERE dup > 0.1e0
    UNION ALL SELECT 'ERROR', 'DUPLICATE_ID', NULL, sample_id, count(*)::VARCHAR FROM seen GROUP BY sample_id HAVING count(*) > 1
    UNION ALL SELECT 'WARN', 'BATCH_SIZE_MEMORY_RISK', NULL, NULL, '2'
    UNION ALL SELECT 'WARN', 'NUM_WORKERS_MEMORY_RISK', NULL, NULL, '4'
    UNION ALL SELECT 'WARN', 'PIN_MEMORY_MEMORY_RISK', NULL, NULL, 'True'"""


_RISKY = {"train_batch_size": 2, "num_workers": 4, "pin_memory": True}


@query("R03_lint_manifest", _lint_sql())
def r03(spark, d):
    issues = manifest_issues(spark, d, LintConfig(**_RISKY))
    return issues.select("severity", "code", "line", "sample_id", "value")


def _messages_sql(issues: str) -> str:
    """Message and fix of the rows of `issues` (severity, code, line, sample_id, value, path), by plain replacement."""
    texts = ", ".join(
        "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in (code, message, fix)) + ")"
        for code, (_, message, fix) in lint.CODES.items()
    )
    slots = {
        "line": "i.line::VARCHAR",
        "sample": "i.sample_id",
        "path": "i.path",
        "suffix": "'.gif'",
        "found": "CASE code WHEN 'FPS_MISMATCH' THEN printf('%.3f', i.value::DOUBLE) ELSE i.value END",
        "want": "CASE code WHEN 'WIDTH_MISMATCH' THEN '1280' WHEN 'HEIGHT_MISMATCH' THEN '704' WHEN 'FPS_MISMATCH' THEN '24.000' ELSE '121' END",
    }
    message = "t.message"
    for name, value in slots.items():
        message = f"replace({message}, '{{{name}}}', coalesce({value}, ''))"
    return f"""SELECT i.severity, i.code, i.line, i.sample_id, {message} AS message, t.fix
    FROM ({issues}) i JOIN (VALUES {texts}) t(code, message, fix) USING (code)"""


@query(
    "R03_lint_messages",
    _messages_sql(f"WITH {_LINES} SELECT l.*, rowz.path FROM ({_lint_sql()}) l LEFT JOIN rowz ON rowz.line = l.line"),
)
def r03c(spark, d):
    issues = manifest_issues(spark, d, LintConfig(**_RISKY))
    return issues.select("severity", "code", "line", "sample_id", "message", "fix")


@query(
    "R03_lint_without_rows",
    _messages_sql(
        f"""WITH {_LINES}, none AS (SELECT NULL::VARCHAR AS sample_id, NULL::VARCHAR AS value)
    SELECT 'ERROR' AS severity, CASE kind WHEN 'bad' THEN 'MANIFEST_BAD_JSON' ELSE 'MANIFEST_ROW_NOT_OBJECT' END AS code, line,
      sample_id, value, NULL::VARCHAR AS path FROM raw, none WHERE kind IN ('bad', 'list')
    UNION ALL SELECT 'ERROR', 'MANIFEST_EMPTY', NULL, sample_id, value, NULL FROM none
    UNION ALL SELECT 'ERROR', 'MANIFEST_NOT_FOUND', NULL, sample_id, value, '/data/absent/manifest.jsonl' FROM none"""
    ),
)
def r03d(spark, d):
    # the broken and blank lines of the manifest alone, and beside them a manifest that is not there
    lines = manifest_lines(spark, d).filter("doc_id % 40 IN (1, 2, 3)")
    rows, read_issues = manifests.scan_manifest(lines.select((c("doc_id") + 1).alias("line"), c("value").alias("raw")))
    stats = media_stats(spark, d)
    found = lint.lint_manifest(rows, read_issues, stats.select("path"), stats, "/data")
    _, absent = manifests.read_lenient(spark, "/data/absent/manifest.jsonl")
    return found.unionByName(absent).select("severity", "code", "line", "sample_id", "message", "fix")


@query(
    "R03_lint_early_stop",
    f"""WITH {_LINES}, stop AS (SELECT line AS at FROM (SELECT line, row_number() OVER (ORDER BY line) AS k
      FROM rowz JOIN stat ON rowz.path = stat.path WHERE rowz.video <> '' AND found AND decode_error IS NOT NULL) WHERE k = 5)
    SELECT i.*, coalesce(i.line > stop.at, false) AS after_stop FROM ({_lint_sql()}) i LEFT JOIN stop ON true
    UNION ALL SELECT 'ERROR', 'TOO_MANY_DECODE_FAILURES', NULL, NULL, NULL, false FROM stop""",
)
def r03b(spark, d):
    return manifest_issues(spark, d, LintConfig(max_decode_failures=5, **_RISKY)).select(
        "severity", "code", "line", "sample_id", "value", "after_stop"
    )


@query(
    "R04_training_gate",
    f"""SELECT count(*) FILTER (severity = 'ERROR') AS error_count, count(*) FILTER (severity = 'WARN') AS warning_count,
    count(*) FILTER (severity = 'ERROR') = 0 AS ok_to_train FROM ({_lint_sql()})""",
)
def r04(spark, d):
    return lint.training_gate(manifest_issues(spark, d, LintConfig(**_RISKY)))


@query(
    "A03_issue_counts",
    f"""SELECT severity, code, count(*) AS n FROM ({_lint_sql()}) GROUP BY severity, code
    UNION ALL SELECT severity, NULL, count(*) FROM ({_lint_sql()}) GROUP BY severity""",
)
def a03(spark, d):
    return lint.issue_counts(manifest_issues(spark, d, LintConfig(**_RISKY)))


@query(
    "A18_duplicate_ids",
    f"WITH {_LINES} SELECT sample_id, count(*) AS n FROM rowz GROUP BY sample_id HAVING count(*) > 1",
)
def a18(spark, d):
    lines = manifest_lines(spark, d).select((c("doc_id") + 1).alias("line"), c("value").alias("raw"))
    return lint.duplicate_ids(manifests.parsed_rows(manifests.classify_lines(lines)))


@query(
    "W09_running_decode_failures",
    f"""WITH {_LINES} SELECT line, sum(CASE WHEN decode_error IS NOT NULL THEN 1 ELSE 0 END) OVER (ORDER BY line)::BIGINT AS failures_so_far
    FROM rowz LEFT JOIN (SELECT * FROM stat WHERE found) s ON rowz.path = s.path""",
)
def w09(spark, d):
    from clipwarden.operators.ordered import running_sums

    lines = manifest_lines(spark, d).select((c("doc_id") + 1).alias("line"), c("value").alias("raw"))
    rows = manifests.parsed_rows(manifests.classify_lines(lines)).select("line", "video")
    rows = rows.withColumn("path", paths.resolve_path(c("video"), "/data"))
    joined = rows.join(media_stats(spark, d).select("path", "decode_error"), "path", "left").select("line", "decode_error")
    failed = F.when(c("decode_error").isNotNull(), 1).otherwise(0).cast("bigint")
    return running_sums(joined, [], ["line"], {"failures_so_far": failed}).select("line", "failures_so_far")


# --- source screening ------------------------------------------------------


def source_infos(spark, d):
    """Documents as source metadata: title is the first line, description the whole text."""
    n = c("doc_id")
    words = F.element_at(F.array(*[F.lit(k) for k in (*KEEP_KEYWORDS, "plain", "city", "zen garden", "Top 10 best")]), (n % 22 + 1).cast("int"))
    return b.table(spark, d, "documents").select(
        F.concat(F.lit("https://v.org/"), n.cast("string")).alias("url"),
        F.concat(F.initcap(words), F.lit(" "), c("source"), F.when(n % 3 == 0, " Gimbal live").otherwise("")).alias("title"),
        c("text").alias("description"),
        F.when(n % 13 == 0, F.lit(0.0)).otherwise((n % 200) * F.lit(1.0)).alias("duration"),
        F.when(n % 6 == 0, F.lit(None)).otherwise(640 + 640 * (n % 3)).cast("int").alias("width"),
        (360 + 360 * (n % 3)).cast("int").alias("height"),
        F.when(n % 5 == 0, F.lit(None)).otherwise(F.lit(15.0) + (n % 4) * F.lit(3.0)).alias("fps"),
        F.when(n % 17 == 0, "timed out").alias("error"),
    )


def _kw(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_INFO = f"""info AS (SELECT doc_id, 'https://v.org/' || doc_id AS url, lower(({_kw([*KEEP_KEYWORDS, "plain", "city", "zen garden", "Top 10 best"])})[doc_id % 22 + 1]
      || ' ' || source || CASE WHEN doc_id % 3 = 0 THEN ' Gimbal live' ELSE '' END) AS title, lower(text) AS descr,
    CASE WHEN doc_id % 13 = 0 THEN 0e0 ELSE (doc_id % 200)::DOUBLE END AS duration,
    CASE WHEN doc_id % 6 <> 0 THEN 640 + 640 * (doc_id % 3) END AS width, 360 + 360 * (doc_id % 3) AS height,
    CASE WHEN doc_id % 5 <> 0 THEN 15e0 + (doc_id % 4) * 3e0 END AS fps, CASE WHEN doc_id % 17 = 0 THEN 'timed out' END AS error FROM documents),
  hit AS (SELECT *, list_filter({_kw(REJECT_KEYWORDS)}, lambda k: contains(title, k) OR contains(descr, k))[1] AS rej,
    list_filter({_kw(KEEP_KEYWORDS)}, lambda k: contains(title, k)) AS keeps FROM info),
  scored_src AS (SELECT *, CASE WHEN error IS NOT NULL OR rej IS NOT NULL THEN 0e0 ELSE least(1e0, 0.5e0 + 0.15e0 * len(keeps)
      + CASE WHEN duration < 30 THEN -0.3e0 WHEN duration > 120 THEN 0.1e0 ELSE 0e0 END
      + CASE WHEN width IS NULL THEN 0e0 WHEN height >= 1080 AND width >= 1920 THEN 0.1e0 WHEN height < 704 OR width < 1280 THEN -0.3e0 ELSE 0e0 END
      + CASE WHEN fps IS NULL THEN 0e0 WHEN abs(fps - 24e0) < 0.1e0 THEN 0.1e0 WHEN fps < 20 THEN -0.2e0 ELSE 0e0 END) END AS s,
    CASE WHEN error IS NOT NULL THEN 'metadata_error:' || error WHEN rej IS NOT NULL THEN CASE WHEN contains(title, rej) THEN 'reject_title:' ELSE 'reject_desc:' END || rej
      ELSE coalesce(nullif(concat_ws('; ', nullif(array_to_string(list_transform(keeps, lambda k: 'keep:' || k), '; '), ''),
        CASE WHEN duration < 30 THEN 'too_short' WHEN duration > 120 THEN 'good_duration' END,
        CASE WHEN width IS NULL THEN NULL WHEN height >= 1080 AND width >= 1920 THEN 'high_resolution' WHEN height < 704 OR width < 1280 THEN 'low_resolution' END,
        CASE WHEN abs(fps - 24e0) < 0.1e0 THEN 'native_24fps' WHEN fps < 20 THEN 'low_fps' END), ''), 'no_signals') END AS why FROM hit),
  scored_round AS (SELECT * REPLACE (round(s, 6) AS s) FROM scored_src)"""


def _scored(spark, d):
    # rounded, so that sums taken in another order compare alike
    return prescreen.score_metadata(source_infos(spark, d)).withColumn("metadata_score", F.round("metadata_score", 6))


@query("R05_score_metadata", f"WITH {_INFO} SELECT url, s AS metadata_score, why AS metadata_reason FROM scored_round")
def r05(spark, d):
    return _scored(spark, d).select("url", "metadata_score", "metadata_reason")


_REC = """rec AS (SELECT url, CASE WHEN s <= 0 THEN 'REJECT' WHEN s < 0.5e0 THEN 'REVIEW' ELSE 'KEEP' END AS recommendation,
    CASE WHEN s > 0 AND s < 0.5e0 THEN 'weak_metadata' ELSE why END AS reason FROM scored_round)"""


@query("R06_recommend_metadata", f"WITH {_INFO}, {_REC} SELECT * FROM rec")
def r06(spark, d):
    return prescreen.recommend_by_metadata(_scored(spark, d)).select("url", "recommendation", "reason")


def source_samples(spark, d):
    n = c("doc_id")
    metric = lambda m, q: F.when(n % 19 != 0, (n % m) / F.lit(q))
    return b.table(spark, d, "documents").filter(n % 23 != 0).select(
        F.concat(F.lit("https://v.org/"), n.cast("string")).alias("url"),
        F.lit(True).alias("downloaded"),
        metric(11, 100.0).alias("sample_duplicate_ratio"),
        metric(7, 8.0).alias("sample_static_ratio"),
        metric(5, 6.0).alias("sample_timelapse_score"),
    )


@query(
    "R07_recommend_sample",
    f"""WITH {_INFO}, smp AS (SELECT *, doc_id % 23 <> 0 AS down, CASE WHEN doc_id % 19 <> 0 THEN (doc_id % 11) / 100e0 END AS du,
      CASE WHEN doc_id % 19 <> 0 THEN (doc_id % 7) / 8e0 END AS st, CASE WHEN doc_id % 19 <> 0 THEN (doc_id % 5) / 6e0 END AS tl FROM scored_round),
    fl AS (SELECT *, concat_ws('; ', CASE WHEN du > 0.05e0 THEN printf('sample_dup=%.2f%%', du * 100e0) END,
      CASE WHEN st > 0.5e0 THEN printf('sample_static=%.2f%%', st * 100e0) END, CASE WHEN tl > 0.5e0 THEN printf('sample_timelapse=%.2f', tl) END) AS flags FROM smp)
    SELECT url, CASE WHEN s <= 0 THEN 'REJECT' WHEN duration <= 0 OR NOT down OR du IS NULL THEN 'REVIEW' WHEN flags <> '' THEN 'REJECT'
      WHEN s < 0.5e0 THEN 'REVIEW' ELSE 'KEEP' END AS recommendation,
    CASE WHEN s <= 0 THEN why WHEN duration <= 0 THEN 'no_duration' WHEN NOT down THEN 'sample_download_failed' WHEN du IS NULL THEN 'sample_decode_failed'
      WHEN flags <> '' THEN flags WHEN s < 0.5e0 THEN 'weak_metadata' ELSE 'sample_ok' END AS reason FROM fl""",
)
def r07(spark, d):
    return prescreen.recommend_by_sample(_scored(spark, d), source_samples(spark, d)).select("url", "recommendation", "reason")


@query(
    "T03_order_sources",
    f"""WITH {_INFO}, {_REC} SELECT row_number() OVER (ORDER BY CASE recommendation WHEN 'KEEP' THEN 0 WHEN 'REVIEW' THEN 1 ELSE 2 END, url) - 1 AS place,
    url, recommendation FROM rec""",
)
def t03(spark, d):
    from clipwarden.operators.ordered import global_index

    ranked = prescreen.recommend_by_metadata(_scored(spark, d)).select("url", "recommendation")
    ranked = ranked.withColumn("_r", prescreen.recommendation_rank(c("recommendation")))
    return global_index(ranked, ["_r", "url"], "place").drop("_r")


@query(
    "A19_recommendation_counts",
    f"""WITH {_INFO}, {_REC} SELECT count(*) AS total, count(*) FILTER (recommendation = 'KEEP') AS KEEP,
    count(*) FILTER (recommendation = 'REVIEW') AS REVIEW, count(*) FILTER (recommendation = 'REJECT') AS REJECT FROM rec""",
)
def a19(spark, d):
    return prescreen.recommendation_counts(prescreen.recommend_by_metadata(_scored(spark, d)))


# --- filters and checks ----------------------------------------------------


def latest_quality(spark, d):
    """One quality row per clip file: the last one of each name."""
    g = b.graded(spark, d).filter(c("l_suppkey") % 5 != 0)
    g = g.select("path", "grade", "source_frames", "duplicate_frame_ratio", *b.ROW_ORDER)
    return grade.latest_by_name(g, paths.basename(c("path")), b.ROW_ORDER)


LATEST_SQL = (
    b.GRADED_SQL
    + f""", latest AS (SELECT * FROM (SELECT *, clip_id || '.mp4' AS name,
      row_number() OVER (PARTITION BY clip_id ORDER BY {", ".join(k + " DESC" for k in b.ROW_ORDER)}) AS rn FROM graded
      WHERE l_suppkey % 5 <> 0) WHERE rn = 1)"""
)


def clip_manifest(spark, d):
    t = b.table(spark, d, "lineitem")
    cid = F.concat(F.lit("clip_"), c("l_orderkey").cast("string"), F.lit("_node"), c("l_linenumber").cast("string"))
    return t.select(
        cid.alias("id"), F.when(c("l_partkey") % 7 == 0, "").otherwise(F.concat(F.lit("v/"), cid, F.lit(".mp4"))).alias("video"), *b.ROW_ORDER
    )


@query(
    "R08_filter_clips",
    f"""WITH {LATEST_SQL} SELECT m.clip_id AS id, {', '.join('m.' + k for k in b.ROW_ORDER)} FROM clips m LEFT JOIN latest q ON q.clip_id = m.clip_id
    WHERE coalesce(q.grade, 'PASS') IN ('PASS', 'REVIEW') AND coalesce(q.duplicate_frame_ratio, 0) <= 0.03e0""",
)
def r08(spark, d):
    return grade.filter_clips(clip_manifest(spark, d), latest_quality(spark, d), ["pass", " review"]).select("id", *b.ROW_ORDER)


@query(
    "R09_usable_rows",
    "SELECT doc_id FROM documents WHERE doc_id % 4 <> 0 AND doc_id % 3 <> 0",
)
def r09(spark, d):
    rows = b.prompts(spark, d).withColumn("id", F.when(c("doc_id") % 4 != 0, c("id")))
    # every video also lies in another folder, where it does not count
    here, other = (F.concat(F.lit(f), paths.basename(c("video"))) for f in ("/data/clips/", "/data/old/"))
    files = b.prompts(spark, d).filter(c("doc_id") % 3 != 0).select(here.alias("path"))
    files = files.unionByName(b.prompts(spark, d).select(other.alias("path")))
    rows = rows.withColumn("video", F.concat(F.lit("./clips/"), paths.basename(c("video"))))
    return rec.usable_rows(rows, files, "/data").select("doc_id")


FILES_SQL = f"""filelist AS (SELECT {ROW}, [
      {{'n': 0, 'height': (l_quantity * 60)::INTEGER, 'width': (l_partkey % 4 * 640)::INTEGER, 'fps': CASE WHEN l_suppkey % 5 <> 0 THEN (l_linenumber * 10)::DOUBLE END,
        'link': CASE WHEN l_partkey % 6 = 0 THEN '' ELSE 'f' || l_partkey END}},
      {{'n': 1, 'height': (l_quantity * 60)::INTEGER, 'width': 1920::INTEGER, 'fps': 25e0, 'link': 'g' || l_partkey}},
      {{'n': 2, 'height': 1080::INTEGER, 'width': 1920::INTEGER, 'fps': 60e0, 'link': 'h' || l_partkey}}] AS fs FROM lineitem),
    files AS (SELECT {ROW}, unnest(fs, recursive := true) FROM filelist)"""


def video_files(spark, d):
    """Line items as videos with three nested renditions each."""
    key = c("l_partkey").cast("string")

    def rendition(height, width, fps, link):
        return F.struct(
            height.cast("int").alias("height"), width.cast("int").alias("width"), fps.cast("double").alias("fps"),
            link.alias("link"), F.lit("video/mp4").alias("file_type"),
        )

    tall = c("l_quantity") * 60
    return b.table(spark, d, "lineitem").select(
        *b.ROW_ORDER,
        F.array(
            rendition(
                tall, c("l_partkey") % 4 * 640, F.when(c("l_suppkey") % 5 != 0, c("l_linenumber") * 10),
                F.when(c("l_partkey") % 6 == 0, "").otherwise(F.concat(F.lit("f"), key)),
            ),
            rendition(tall, F.lit(1920), F.lit(25.0), F.concat(F.lit("g"), key)),
            rendition(F.lit(1080), F.lit(1920), F.lit(60.0), F.concat(F.lit("h"), key)),
        ).alias("video_files"),
    )


_ELIGIBLE = "height >= 1200 AND NOT (coalesce(fps, 0) > 0 AND fps < 24) AND link <> ''"


@query("R10_eligible_files", f"WITH {FILES_SQL} SELECT {ROW}, len(list_filter(fs, lambda f: f.height >= 1200 AND NOT (coalesce(f.fps, 0) > 0 AND f.fps < 24) AND f.link <> ''))::INTEGER AS eligible FROM filelist")
def r10(spark, d):
    return video_files(spark, d).select(*b.ROW_ORDER, F.size(select.eligible_files(c("video_files"), 1200, 24)).alias("eligible"))


@query(
    "T01_best_file",
    f"""WITH {FILES_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY {ROW} ORDER BY height DESC, width DESC, coalesce(fps, 0) DESC, n) AS rn FROM files WHERE {_ELIGIBLE})
    SELECT {ROW}, height, width, fps, link FROM k WHERE rn = 1""",
)
def t01(spark, d):
    best = select.best_file(c("video_files"), 1200, 24)
    t = video_files(spark, d).select(*b.ROW_ORDER, best.alias("f")).filter("f is not null")
    return t.select(*b.ROW_ORDER, "f.height", "f.width", "f.fps", "f.link")


_REQ = "[" + ", ".join(f"'{k}'" for k in CLIP_COLUMNS) + "]"


@query(
    "R11_schema_check",
    f"""WITH {b.RECORDS_SQL}, want AS (SELECT unnest({_REQ}) AS k), n AS (SELECT count(*) AS rows, count(clip_id) AS clip_id, count(fps) AS fps,
      count(caption) AS caption, count(o_orderkey) AS o_orderkey FROM records)
    SELECT CASE WHEN k IN ('clip_id', 'fps', 'caption') THEN 'present' ELSE 'missing' END AS kind, k AS column,
      CASE k WHEN 'clip_id' THEN clip_id WHEN 'fps' THEN fps WHEN 'caption' THEN caption ELSE 0 END AS non_null, rows FROM want, n
    UNION ALL SELECT 'extra', 'o_orderkey', o_orderkey, rows FROM n""",
)
def r11(spark, d):
    return validate.schema_check(b.records(spark, d).select("o_orderkey", "clip_id", "fps", "caption"))


@query(
    "R12_spec_violations",
    f"""WITH {b.RECORDS_SQL}, v AS (SELECT (width <> 1280)::INT + (height <> 704)::INT + (abs(fps - 24e0) > 0.5e0)::INT + (num_frames <> 121)::INT
      + (abs(duration_sec - 5.041667e0) > 0.5e0)::INT AS n FROM records)
    SELECT sum(n)::BIGINT AS violations, count(*) FILTER (n > 0) AS rows_violating, count(*) AS rows FROM v""",
)
def r12(spark, d):
    return validate.spec_violations(b.records(spark, d))


@query(
    "R13_id_sets",
    f"""WITH {b.RECORDS2_SQL} SELECT clip_id AS id, 'a_only' AS side FROM records WHERE clip_id NOT IN (SELECT clip_id FROM records2)
    UNION ALL SELECT clip_id, 'b_only' FROM records2 WHERE clip_id NOT IN (SELECT clip_id FROM records)""",
)
def r13(spark, d):
    return validate.id_set_difference(b.records(spark, d), b.records_v2(spark, d), "clip_id", "clip_id")


@query(
    "U02_set_equality",
    f"""WITH {b.RECORDS2_SQL}, x AS (SELECT count(*) AS n FROM records WHERE clip_id NOT IN (SELECT clip_id FROM records2)),
    y AS (SELECT count(*) AS n FROM records2 WHERE clip_id NOT IN (SELECT clip_id FROM records))
    SELECT x.n = 0 AND y.n = 0 AS equal, x.n AS a_only, y.n AS b_only FROM x, y""",
)
def u02(spark, d):
    return validate.sets_equal(b.records(spark, d), b.records_v2(spark, d), "clip_id", "clip_id")


def listed_files(spark, d):
    """Recorded files below /data, a few of them gone or with other content."""
    n = c("o_orderkey")
    return b.records(spark, d).filter(n % 21 != 0).select(
        F.concat(F.lit("/data//./"), c("clip_uri")).alias("path"),
        F.when(n % 31 == 0, F.sha2(F.lit("changed"), 256)).otherwise(c("clip_sha256")).alias("sha256"),
        F.when(n % 13 == 0, F.sha2(F.lit("changed"), 256)).otherwise(c("first_frame_sha256")).alias("frame_sha256"),
        "first_frame_uri",
        ((n % 100) / F.lit(8.0)).alias("size_mb"),
    )


def all_files(spark, d):
    """The recorded files, listed twice, and one of the same base name in another folder for every record."""
    listed = listed_files(spark, d).select("path", "sha256", "size_mb")
    other = b.records(spark, d).select(
        F.concat(F.lit("/data/old/"), paths.basename(c("clip_uri"))).alias("path"), F.lit("other").alias("sha256"),
        F.lit(99.0).alias("size_mb"),
    )
    return listed.unionByName(listed).unionByName(other)


@query(
    "R14_file_counts",
    f"WITH {b.RECORDS_SQL} SELECT 'clips' AS kind, count(*) AS rows, count(*) FILTER (o_orderkey % 21 <> 0) AS files, false AS ok FROM records",
)
def r14(spark, d):
    return validate.file_count_check(b.records(spark, d), listed_files(spark, d), "clips")


_HASH = """SELECT o_orderkey, CASE WHEN o_orderkey % 21 = 0 THEN 'missing' WHEN o_orderkey % 31 = 0 THEN 'mismatch' ELSE 'match' END AS hash_state,
    CASE WHEN o_orderkey % 21 = 0 THEN {m} ELSE o_orderkey % 31 <> 0 END AS hash_ok FROM orders"""


@query("R15_hash_check_skip", _HASH.format(m="true"))
def r15(spark, d):
    return validate.hash_check(b.records(spark, d), all_files(spark, d), "clip_uri", "clip_sha256", "skip", "/data").select(
        "o_orderkey", "hash_state", "hash_ok"
    )


@query("R15_hash_check_fail", _HASH.format(m="false"))
def r15b(spark, d):
    return validate.hash_check(b.records(spark, d), all_files(spark, d), "clip_uri", "clip_sha256", "fail", "/data").select(
        "o_orderkey", "hash_state", "hash_ok"
    )


@query(
    "R15_frame_hash_check",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 21 = 0 THEN 'missing' WHEN o_orderkey % 13 = 0 THEN 'mismatch' ELSE 'match' END AS hash_state,
    o_orderkey % 21 = 0 OR o_orderkey % 13 <> 0 AS hash_ok FROM orders""",
)
def r15d(spark, d):
    frames = listed_files(spark, d).select(
        F.concat(F.lit("/data/"), c("first_frame_uri")).alias("path"), c("frame_sha256").alias("sha256")
    )
    checked = validate.hash_check(b.records(spark, d), frames, "first_frame_uri", "first_frame_sha256", "skip", "/data")
    return checked.select("o_orderkey", "hash_state", "hash_ok")


@query(
    "R16_verdict",
    f"""WITH {b.RECORDS2_SQL}, h AS ({_HASH.format(m="true")}), checks AS (
      SELECT 'schema' AS "check", true AS ok, '0' AS detail
      UNION ALL SELECT 'ids', false, (SELECT count(*) FROM records WHERE clip_id NOT IN (SELECT clip_id FROM records2))::VARCHAR || '/'
        || (SELECT count(*) FROM records2 WHERE clip_id NOT IN (SELECT clip_id FROM records))
      UNION ALL SELECT 'hashes', count(*) FILTER (hash_state = 'mismatch') = 0, count(*) FILTER (hash_state = 'mismatch')::VARCHAR FROM h
      UNION ALL SELECT 'spec', sum((width <> 1280)::INT + (height <> 704)::INT + (abs(fps - 24e0) > 0.5e0)::INT + (num_frames <> 121)::INT
        + (abs(duration_sec - 5.041667e0) > 0.5e0)::INT) = 0, sum((width <> 1280)::INT + (height <> 704)::INT + (abs(fps - 24e0) > 0.5e0)::INT
        + (num_frames <> 121)::INT + (abs(duration_sec - 5.041667e0) > 0.5e0)::INT)::VARCHAR FROM records)
    SELECT * FROM checks UNION ALL SELECT 'verdict', bool_and(ok), count(*) FILTER (NOT ok)::VARCHAR FROM checks""",
)
def r16(spark, d):
    rows, v2 = b.records(spark, d), b.records_v2(spark, d)
    schema = validate.schema_check(rows.select(*CLIP_COLUMNS)).agg(F.count_if(c("kind") != "present").alias("n"))
    hashes = validate.hash_totals(validate.hash_check(rows, all_files(spark, d), "clip_uri", "clip_sha256", base="/data"))
    return validate.verdict(
        [
            validate.check_row(schema, "schema", "n = 0", "n"),
            validate.check_row(validate.sets_equal(rows, v2, "clip_id", "clip_id"), "ids", "equal", "concat(a_only, '/', b_only)"),
            validate.check_row(hashes, "hashes", "mismatches = 0", "mismatches"),
            validate.check_row(validate.spec_violations(rows), "spec", "violations = 0", "violations"),
        ]
    )


@query(
    "R17_problem_sources",
    f"""WITH {b.GRADED_SQL}, t AS (SELECT source, count(*) AS total, count(*) FILTER (grade = 'FAIL') AS fail FROM graded WHERE true GROUP BY source)
    SELECT source, total, fail FROM t WHERE fail::DOUBLE / total > 0.5e0 OR fail >= 5""",
)
def r17(spark, d):
    return grade.problem_sources(grade.source_table(b.graded(spark, d))).select("source", "total", "fail")
