"""Queries of sources (S) and sinks (K): data derived from the tables is written, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipwarden.functions import paths
from clipwarden.operators import dedup, grade, lint, prescreen, profile, validate
from clipwarden.plans import bindings as b
from clipwarden.plans.registry import query
from clipwarden.plans.rule_queries import (
    _INFO,
    _LINES,
    _RISKY,
    FILES_SQL,
    _lint_sql,
    manifest_issues,
    manifest_lines,
    media_stats,
    source_infos,
    video_files,
    written_manifest,
)
from clipwarden.session import scratch_path
from clipwarden.sinks import writers
from clipwarden.sources import documents, files, manifests, tables
from clipwarden.spec import CLIP_COLUMNS, LintConfig

c = F.col
ROW = ", ".join(b.ROW_ORDER)


# --- sources ---------------------------------------------------------------


@query(
    "S01_manifest_lenient",
    f"""WITH {_LINES} SELECT line, id, video, length(prompt) AS prompt_chars FROM raw WHERE kind = 'row'""",
)
def s01(spark, d):
    rows, _ = manifests.read_lenient(spark, written_manifest(spark, d))
    return rows.select("line", "id", "video", F.length("prompt").cast("bigint").alias("prompt_chars"))


@query("S01_manifest_issues", f"WITH {_LINES} SELECT severity, code, line FROM (SELECT 'ERROR' AS severity, CASE kind WHEN 'bad' THEN 'MANIFEST_BAD_JSON' ELSE 'MANIFEST_ROW_NOT_OBJECT' END AS code, line FROM raw WHERE kind IN ('bad', 'list'))")
def s01b(spark, d):
    _, issues = manifests.read_lenient(spark, written_manifest(spark, d))
    return issues.select("severity", "code", "line")


def _sound_lines(spark, d, first="video"):
    """Manifest text without broken lines; every third row has no id key."""
    n = c("doc_id")
    fields = [c("video").alias(first), c("prompt")]
    full = F.to_json(F.struct(c("id"), *fields))
    return b.prompts(spark, d).select("doc_id", F.when(n % 3 == 0, F.to_json(F.struct(*fields))).otherwise(full).alias("value"))


def _write_text(spark, lines, name):
    path = scratch_path(spark, name)
    lines.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("value").write.text(path)
    return path


_STRICT = f"WITH {b.PROMPTS_SQL} SELECT CASE WHEN doc_id % 3 = 0 THEN doc_id::VARCHAR ELSE id END AS id, video AS {{k}}, prompt FROM prompts"


@query("S02_manifest_strict", _STRICT.format(k="video"))
def s02(spark, d):
    return manifests.read_strict(spark, _write_text(spark, _sound_lines(spark, d), "manifest")).drop("line")


@query("S04_eval_manifest", _STRICT.format(k="image"))
def s04(spark, d):
    path = _write_text(spark, _sound_lines(spark, d, "image"), "eval")
    return manifests.read_strict(spark, path, ("image", "prompt")).drop("line")


@query("S03_manifest_skip_bad", f"WITH {_LINES} SELECT id, video FROM raw WHERE kind = 'row'")
def s03(spark, d):
    rows = manifests.read_rows(spark, written_manifest(spark, d), "id string, video string, prompt string", on_bad="skip")
    return rows.filter("id is not null or video is not null or prompt is not null").select("id", "video")


@query("S05_clip_records", f"WITH {b.RECORDS_SQL} SELECT {', '.join(CLIP_COLUMNS)} FROM records")
def s05(spark, d):
    path = scratch_path(spark, "clips")
    b.records(spark, d).write.parquet(path)
    return tables.read_clips(spark, path)


@query("S06_whole_table", "SELECT * FROM customer")
def s06(spark, d):
    return tables.read_table(spark, f"{d}/customer.parquet")


_QUALITY = ["path", "source_width", "source_frames", "source_fps", "duplicate_frame_ratio", "conformance_score", "grade", "reason"]


def _quality_csv(spark, d, keep):
    path = scratch_path(spark, "quality_report")
    # line items are put in order before they are measured and graded: they are much narrower
    items = b.table(spark, d, "lineitem").filter(keep)
    rows = items.repartitionByRange(*b.ROW_ORDER).sortWithinPartitions(*b.ROW_ORDER)
    writers.write_quality_csv(_report_rows(b.graded(spark, d, rows)), path, items)
    return path


def _report_rows(rows):
    """Fill the report columns that the binding does not measure."""
    have = rows.columns
    from clipwarden.spec import QUALITY_SCHEMA

    return rows.select(
        *[c(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in QUALITY_SCHEMA]
    )


_LATEST = f"""WITH {b.GRADED_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY clip_id ORDER BY {{o}}) AS rn FROM ({{f}}))"""
_DESC = ", ".join(f"{k} DESC" for k in b.ROW_ORDER)


@query(
    "S07_quality_by_name",
    _LATEST.format(o=_DESC, f="SELECT * FROM graded")
    + " SELECT clip_id || '.mp4' AS name, path, source_width, source_frames, source_fps, duplicate_frame_ratio, round(conformance_score, 9) AS conformance_score, grade, reason FROM r WHERE rn = 1",
)
def s07(spark, d):
    t = tables.read_quality(spark, _quality_csv(spark, d, F.lit(True)))
    return t.select("name", *[F.round(k, 9).alias(k) if k == "conformance_score" else c(k) for k in _QUALITY])


@query(
    "S08_quality_batches",
    _LATEST.format(
        o="batch DESC, " + _DESC,
        f="SELECT *, 0 AS batch FROM graded WHERE l_suppkey % 2 = 0 UNION ALL SELECT *, 2 FROM graded WHERE l_suppkey % 3 = 0"
        " UNION ALL SELECT *, 3 FROM graded WHERE l_suppkey % 6 IN (1, 5)",
    )
    + " SELECT clip_id AS name, source_frames, duplicate_frame_ratio, grade FROM r WHERE rn = 1",
)
def s08(spark, d):
    batches = [
        _quality_csv(spark, d, c("l_suppkey") % 2 == 0),
        scratch_path(spark, "absent"),
        _quality_csv(spark, d, c("l_suppkey") % 3 == 0),
        _quality_csv(spark, d, (c("l_suppkey") % 6).isin(1, 5)),
    ]
    return tables.read_quality_batches(spark, batches).select("name", "source_frames", "duplicate_frame_ratio", "grade")


_EXT = [".mp4", ".MOV", ".txt", ".mkv"]


_FILES = """names AS (SELECT DISTINCT source, source || CASE CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER) % 4
    WHEN 0 THEN '.mp4' WHEN 1 THEN '.MOV' WHEN 2 THEN '.txt' ELSE '.mkv' END AS name FROM documents)"""


def _named_files(spark, d, body):
    """Write one small file per source under its own name, from the executors."""
    folder = scratch_path(spark, "media")
    n = F.regexp_extract("source", r"(\d+)$", 1).cast("int") % 4
    name = F.concat("source", F.element_at(F.array(*[F.lit(e) for e in _EXT]), n + 1))
    rows = b.table(spark, d, "documents").groupBy("source").agg(body.alias("content")).select(name.alias("name"), "content")
    conf = {"folder": folder}

    def put(batches):
        import pyarrow as pa
        from pyarrow import fs

        target, root = fs.FileSystem.from_uri(conf["folder"] if "://" in conf["folder"] else "file://" + conf["folder"].removeprefix("file:"))
        target.create_dir(root, recursive=True)
        for batch in batches:
            for r in batch.to_pylist():
                with target.open_output_stream(f"{root}/{r['name']}") as out:
                    out.write(r["content"].encode())
            yield pa.RecordBatch.from_pydict({"name": batch.column(0)})

    rows.mapInArrow(put, "name string").agg(F.count(F.lit(1))).collect()
    return folder


def _body():
    return F.concat(F.lit("n="), F.count(F.lit(1)).cast("string"), F.lit(";max="), F.max("doc_id").cast("string"))


_BODY_SQL = "SELECT source, 'n=' || count(*) || ';max=' || max(doc_id) AS body FROM documents GROUP BY source"


@query("S09_discover_clips", f"WITH {_FILES} SELECT name FROM names WHERE name NOT LIKE '%.txt' ORDER BY name")
def s09(spark, d):
    return files.discover_clips(spark, _named_files(spark, d, _body())).select("name")


@query(
    "S10_file_inventory",
    f"WITH {_FILES}, s AS ({_BODY_SQL}) SELECT name, length(body)::BIGINT AS bytes, length(body) / 1048576e0 AS size_mb FROM names JOIN s USING (source)",
)
def s10(spark, d):
    return files.list_files(spark, _named_files(spark, d, _body())).select("name", "bytes", "size_mb")


@query(
    "R15_content_hashes",
    f"WITH {_FILES}, s AS ({_BODY_SQL}) SELECT name, sha256(body) AS sha256 FROM names JOIN s USING (source)",
)
def r15c(spark, d):
    return files.content_hashes(spark, _named_files(spark, d, _body())).select("name", "sha256")


@query("S11_url_list", "SELECT url FROM pages WHERE page_id % 3 = 1")
def s11(spark, d):
    path = scratch_path(spark, "urls.txt")
    line = (
        F.when(c("page_id") % 3 == 0, F.concat(F.lit("# "), c("url")))
        .when(c("page_id") % 3 == 1, F.concat(F.lit("  "), c("url"), F.lit(" ")))
        .otherwise("   ")
    )
    b.table(spark, d, "pages").select(line.alias("value")).write.text(path)
    return files.read_urls(spark, path)


@query(
    "S12_log_values",
    """SELECT key, count(*) AS n, round(sum(CASE WHEN isfinite(v) THEN v ELSE 0 END), 4) AS total, count(*) FILTER (isnan(v)) AS nans FROM (
      SELECT 'event_id' AS key, event_id::DOUBLE AS v FROM events UNION ALL SELECT 'value', CASE WHEN event_id % 10 = 0 THEN 'NaN'::DOUBLE ELSE value END FROM events
      UNION ALL SELECT 'flag', (event_id % 2 = 0)::INT::DOUBLE FROM events UNION ALL SELECT 'extra', event_id / 4e0 FROM events WHERE event_id % 5 = 0) GROUP BY key""",
)
def s12(spark, d):
    path = scratch_path(spark, "metrics")
    n = c("event_id")
    text = F.concat(
        F.lit('{"event_id": '), n.cast("string"), F.lit(', "value": '), F.when(n % 10 == 0, "NaN").otherwise(c("value").cast("string")),
        F.lit(', "flag": '), (n % 2 == 0).cast("string"), F.lit(', "name": "12", "ids": [1, 2]'),
        F.when(n % 5 == 0, F.concat(F.lit(', "extra": '), (n / F.lit(4.0)).cast("decimal(20,2)").cast("string"))).otherwise(""),
        F.lit("}"),
    )
    b.table(spark, d, "events").select(text.alias("value")).write.text(path)
    v = documents.read_log_values(spark, path)
    good = F.when(~F.isnan("value"), c("value")).otherwise(F.lit(0.0))
    return v.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(good), 4).alias("total"), F.count_if(F.isnan("value")).alias("nans")
    )


@query(
    "S13_summary_document",
    """SELECT (SELECT count(*) FROM events) AS count, event_type AS metric, unnest(['mean', 'max']) AS stat, unnest([round(avg(value), 6), max(value)]) AS value FROM events GROUP BY event_type""",
)
def s13(spark, d):
    path = scratch_path(spark, "summary")
    per = b.table(spark, d, "events").groupBy("event_type").agg(
        F.create_map(F.lit("mean"), F.round(F.avg("value"), 6), F.lit("max"), F.max("value")).alias("s"), F.count(F.lit(1)).alias("n")
    )
    # one entry per event type, a small fixed set
    doc = per.agg(F.sum("n").alias("count"), F.map_from_entries(F.collect_list(F.struct("event_type", "s"))).alias("metrics"))
    doc.write.json(path)
    return documents.read_summary(spark, path)


@query(
    "S14_search_results",
    f"""WITH {FILES_SQL} SELECT l_orderkey AS id, 'https://s.org/' || l_orderkey || '/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey AS url,
    len(fs)::INTEGER AS files, list_max(list_transform(fs, lambda f: f.height)) AS tallest FROM filelist""",
)
def s14(spark, d):
    path = scratch_path(spark, "search")
    url = F.concat_ws("/", F.lit("https://s.org"), *b.ROW_ORDER[:4])
    video = F.struct(c("l_orderkey").alias("id"), url.alias("url"), "video_files")
    # gzip files are read by one task each: their rows are bounded
    pages = video_files(spark, d).select(F.array(video).alias("videos"))
    pages.write.option("maxRecordsPerFile", 1_000_000).json(path, compression="gzip")
    v = documents.read_search_results(spark, path)
    return v.select("id", "url", F.size("video_files").alias("files"), F.array_max(c("video_files.height")).alias("tallest"))


@query(
    "S15_source_documents",
    f"""WITH {_INFO}, last AS (SELECT max(doc_id) AS doc_id FROM info GROUP BY doc_id // 20)
    SELECT url, duration, width::INTEGER AS width, height::INTEGER AS height, fps, error FROM info JOIN last USING (doc_id)""",
)
def s15(spark, d):
    path = scratch_path(spark, "dumps")
    infos = source_infos(spark, d).withColumn("n", F.regexp_extract("url", r"(\d+)$", 1).cast("bigint"))
    body = F.to_json(F.struct("url", "title", "description", "duration", "width", "height", "fps", "error"))
    # a dump of every twenty documents, one file each: their number grows with the table
    rows = infos.select(F.floor(c("n") / 20).alias("dump"), "n", F.concat(body, F.lit("\n  ")).alias("value"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("n", "value"))), lambda line: line["value"])
    dumps = rows.groupBy("dump").agg(F.array_join(lines, "\n").alias("value")).select("value")
    # a record is a whole dump; files of one folder, as a folder of its own for each would have to be made and listed
    dumps.write.option("maxRecordsPerFile", 1).text(path)
    dumps = documents.read_source_dumps(spark, path)
    return dumps.select("url", "duration", "width", "height", "fps", "error")


@query("S16_history", "SELECT DISTINCT o_custkey AS id FROM orders")
def s16(spark, d):
    path = scratch_path(spark, "history")
    ids = b.table(spark, d, "orders").groupBy(F.floor(c("o_orderkey") / 1000).alias("k")).agg(F.collect_set("o_custkey").alias("downloaded_ids"))
    ids.select("downloaded_ids", F.lit("2026-01-01T00:00:00Z").alias("last_updated")).write.option(
        "maxRecordsPerFile", 1
    ).json(path)
    return tables.read_history(spark, path)


_UP = r"""WITH s AS (SELECT doc_id, CASE WHEN doc_id % 6 = 0 THEN NULL ELSE 'https://h.org/v' || doc_id || CASE WHEN doc_id % 2 = 0 THEN '.MOV?x=1' ELSE '' END END AS link,
      CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN '  ' ELSE source END AS txt, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 'a b/' || doc_id END AS raw FROM documents),
    k AS (SELECT *, CASE WHEN raw IS NULL THEN 'sample_' || lpad(doc_id::VARCHAR, greatest(6, length(doc_id::VARCHAR))::INT, '0') ELSE 'a_b_' || doc_id END AS id FROM s)"""


def _upstream(spark, d):
    n = c("doc_id")
    key = n.cast("string")
    link = F.when(n % 6 != 0, F.concat(F.lit("https://h.org/v"), key, F.when(n % 2 == 0, ".MOV?x=1").otherwise("")))
    t = b.table(spark, d, "documents").select(
        "doc_id",
        link.alias("clip"),
        F.when(n % 7 == 0, F.lit(None)).when(n % 7 == 1, "  ").otherwise(c("source")).alias("txt"),
        F.when(n % 5 != 0, F.concat(F.lit("a b/"), key)).alias("raw"),
    )
    return tables.prepare_upstream(t, "doc_id", "clip", "txt", "raw")


@query(
    "S17_upstream_rows",
    _UP
    + """ SELECT id, 'videos/' || id || CASE WHEN doc_id % 2 = 0 THEN '.mov' ELSE '.mp4' END AS video, coalesce(nullif(trim(txt), ''), 'Video sample ' || id || '.') AS prompt
    FROM k WHERE link IS NOT NULL AND txt IS NOT NULL""",
)
def s17(spark, d):
    return _upstream(spark, d)[0]


@query(
    "S17_upstream_failures",
    _UP
    + """ SELECT doc_id AS index, CASE WHEN txt IS NULL THEN 'missing txt' ELSE 'missing clip' END AS error FROM k WHERE link IS NULL OR txt IS NULL""",
)
def s17b(spark, d):
    return _upstream(spark, d)[1]


# --- sinks -----------------------------------------------------------------


@query("K01_quality_csv", f"WITH {b.GRADED_SQL} SELECT path, source_width, duplicate_frame_ratio, scene_cut_count, grade, reason FROM graded")
def k01(spark, d):
    path = _quality_csv(spark, d, F.lit(True))
    from clipwarden.spec import QUALITY_SCHEMA

    t = spark.read.schema(QUALITY_SCHEMA).csv(path, header=True)
    return t.select("path", "source_width", "duplicate_frame_ratio", "scene_cut_count", "grade", "reason")


@query(
    "K02_summary_json",
    f"""WITH {b.GRADED_SQL} SELECT count(*) AS total, count(*) FILTER (grade = 'PASS') AS pass, round(avg(conformance_score), 6) AS mean_conformance,
    count(*) FILTER (reason LIKE 'duplicates=%') AS duplicates, 0.05e0 AS dup_ratio FROM graded""",
)
def k02(spark, d):
    path = scratch_path(spark, "summary")
    writers.write_summary(b.graded(spark, d), path)
    t = spark.read.json(path)
    return t.select(
        "total", "pass", F.round("aggregate.mean_conformance_score", 6).alias("mean_conformance"),
        c("issues_by_category.duplicates").alias("duplicates"), c("thresholds.dup_ratio").alias("dup_ratio"),
    )


@query("K03_clip_parquet", f"WITH {b.RECORDS_SQL} SELECT clip_id, clip_sha256, num_frames, '' AS caption FROM records")
def k03(spark, d):
    path = scratch_path(spark, "clips")
    writers.write_clips(b.records(spark, d).drop("caption"), path)
    return tables.read_clips(spark, path, typed=False).select("clip_id", "clip_sha256", "num_frames", "caption")


@query("K04_manifest", f"WITH {b.RECORDS_SQL} SELECT clip_id AS id, clip_uri AS video FROM records")
def k04(spark, d):
    path = scratch_path(spark, "manifest")
    writers.write_manifest(b.records(spark, d), path)
    return spark.read.schema("id string, video string").json(path)


@query("K04_manifest_captioned", f"WITH {b.RECORDS_SQL} SELECT clip_id AS id, clip_uri AS video, coalesce(caption, '') AS prompt FROM records")
def k04b(spark, d):
    path = scratch_path(spark, "manifest")
    writers.write_manifest(b.records(spark, d), path, captioned=True)
    return spark.read.schema("id string, video string, prompt string").json(path)


@query(
    "K05_interval_manifest",
    """WITH r AS (SELECT sha256(o_custkey || chr(31) || o_orderkey || chr(31) || o_orderstatus) AS h FROM orders),
    s AS (SELECT count(*) AS n, sum(('0x' || substring(h, 1, 15))::BIGINT)::VARCHAR AS a, sum(('0x' || substring(h, 16, 15))::BIGINT)::VARCHAR AS b FROM r)
    SELECT '2.0.0' AS protocol_version, '2.0.0' AS schema_version, 'video_v1' AS spec_id, 7 AS netuid, 'key' AS miner_hotkey, 1 AS interval_id,
    '2026-01-01T00:00:00Z' AS created_at, n AS record_count, sha256(n || ':' || a || ':' || b) AS dataset_sha256 FROM s""",
)
def k05(spark, d):
    rows = b.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    doc = writers.interval_document(rows, 7, "key", 1, "2026-01-01T00:00:00Z")
    path = scratch_path(spark, "interval")
    doc.write.json(path)
    return spark.read.schema(doc.schema).json(path)


@query(
    "K06_training_manifest",
    f"""WITH {b.GRADED_SQL} SELECT clip_id AS id, 'clips/' || clip_id || '.mp4' AS video, 'A calm sea, ' || source_height || 'p' AS prompt FROM graded WHERE grade IN ('PASS', 'REVIEW')""",
)
def k06(spark, d):
    path = scratch_path(spark, "manifest")
    writers.write_training_manifest(b.graded(spark, d), path, "A {description}, {resolution}", " calm   sea ")
    return spark.read.schema("id string, video string, prompt string").json(path)


@query(
    "K07_diagnostics",
    f"SELECT severity, code, line, sample_id, value FROM ({_lint_sql()})",
)
def k07(spark, d):
    path = scratch_path(spark, "diagnostics")
    issues = manifest_issues(spark, d, LintConfig(**_RISKY))
    inventory = media_stats(spark, d).select(
        F.lit(1).alias("line"), F.lit("x").alias("id"), c("path").alias("video"), "width", "height", "frames", "fps",
        F.lit(0.0).alias("file_size_mb"), "duplicate_frame_ratio", F.lit(0.0).alias("aspect_error"),
    )
    writers.write_diagnostics(issues, inventory, path)
    schema = "severity string, code string, message string, fix string, line bigint, sample_id string, video string, value string"
    return spark.read.schema(schema).json(f"{path}/diagnostics_jsonl").select("severity", "code", "line", "sample_id", "value")


@query(
    "K08_prescreen_lists",
    f"""WITH {_INFO} SELECT CASE WHEN s <= 0 THEN 'REJECT' WHEN s < 0.5e0 THEN 'REVIEW' ELSE 'KEEP' END AS recommendation, count(*) AS n, min(url) AS first_url FROM scored_round GROUP BY 1""",
)
def k08(spark, d):
    path = scratch_path(spark, "prescreen")
    scored = prescreen.score_metadata(source_infos(spark, d)).withColumn("metadata_score", F.round("metadata_score", 6))
    nothing = F.lit(None).cast("double")
    screened = prescreen.recommend_by_metadata(scored).withColumns(
        {k: nothing for k in ("sample_duplicate_ratio", "sample_static_ratio", "sample_timelapse_score")}
    )
    writers.write_prescreen(screened, path)
    t = spark.read.schema("value string, recommendation string").text(f"{path}/urls")
    return t.groupBy("recommendation").agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("first_url"))


@query(
    "K08_prescreen_report",
    f"""WITH {_INFO} SELECT url, printf('%.2f', s) AS metadata_score, printf('%.4f', (doc_id % 11) / 100e0) AS sample_duplicate_ratio FROM scored_round""",
)
def k08b(spark, d):
    path = scratch_path(spark, "prescreen")
    scored = prescreen.score_metadata(source_infos(spark, d)).withColumn("metadata_score", F.round("metadata_score", 6))
    n = F.regexp_extract("url", r"(\d+)$", 1).cast("bigint")
    screened = prescreen.recommend_by_metadata(scored).withColumns(
        {
            "sample_duplicate_ratio": n % 11 / F.lit(100.0),
            "sample_static_ratio": F.lit(None).cast("double"),
            "sample_timelapse_score": F.lit(None).cast("double"),
        }
    )
    writers.write_prescreen(screened, path)
    t = spark.read.csv(f"{path}/report", header=True)
    return t.select("url", "metadata_score", "sample_duplicate_ratio")


@query(
    "K09_quarantine",
    f"WITH {b.GRADED_SQL} SELECT {ROW}, CASE WHEN grade = 'FAIL' THEN 'quarantine' ELSE 'kept' END AS route FROM graded",
)
def k09(spark, d):
    path = scratch_path(spark, "routed")
    writers.write_quarantine(b.graded(spark, d), path)
    return spark.read.parquet(path).select(*b.ROW_ORDER, "route")


@query(
    "K09_name_collisions",
    f"WITH {b.GRADED_SQL} SELECT clip_id || '.mp4' AS name, count(*) AS n FROM graded WHERE grade = 'FAIL' GROUP BY 1 HAVING count(*) > 1",
)
def k09b(spark, d):
    return writers.name_collisions(b.graded(spark, d))


@query(
    "K10_kept_and_removed",
    """WITH r AS (SELECT *, min((o_orderkey % 60, o_orderkey)) OVER (PARTITION BY o_custkey) AS best FROM orders)
    SELECT o_orderkey, CASE WHEN (o_orderkey % 60, o_orderkey) = best THEN 'kept' ELSE 'removed' END AS decision FROM r""",
)
def k10(spark, d):
    rows = b.records(spark, d).withColumns({"source_frames": F.lit(121), "dup_ratio": F.lit(0.0)})
    path = scratch_path(spark, "decided")
    writers.write_decisions(dedup.one_per_source(rows, tiebreak=["o_orderkey"]), path)
    return spark.read.parquet(path).select("o_orderkey", "decision")


@query(
    "K11_cue_list_lines",
    f"""WITH {b.RECORDS_SQL}, s AS (SELECT source_video_url AS url, clip_start_sec, CAST(round_even(clip_start_sec, 0) AS BIGINT) AS x FROM records)
    SELECT url || ' | ' || CASE WHEN x < 60 THEN x::VARCHAR ELSE printf('%d:%02d', x // 60, x % 60) END AS value FROM s""",
)
def k11(spark, d):
    path = scratch_path(spark, "urls")
    lists = profile.cue_lists(b.records(spark, d), "source_video_url", "clip_start_sec")
    writers.write_cue_lists(lists, path, "source_video_url")
    return spark.read.text(path)


@query("K12_append_log", f"WITH {b.RUNLOG_SQL} SELECT run, step, round(loss, 9) AS loss FROM runlog")
def k12(spark, d):
    path = scratch_path(spark, "metrics")
    rows = b.runlog(spark, d)
    writers.append_log(rows.filter("step < 2"), path)
    writers.append_log(rows.filter("step >= 2"), path)
    t = spark.read.schema("run bigint, step bigint, loss double").json(path)
    return t.select("run", "step", F.round("loss", 9).alias("loss"))


@query("K12_append_csv", f"WITH {b.RUNLOG_SQL} SELECT run::VARCHAR AS run, step::VARCHAR AS step, CAST(NULL AS VARCHAR) AS lr FROM runlog")
def k12b(spark, d):
    path = scratch_path(spark, "metrics_csv")
    rows = b.runlog(spark, d)
    writers.append_log(rows.filter("step < 2"), path, "csv", ["run", "step", "lr"])
    writers.append_log(rows.filter("step >= 2"), path, "csv", ["run", "step", "lr"])
    return spark.read.csv(path, header=True)


@query("K13_event_log", "SELECT event_id AS time, event_type AS event, user_id, value FROM events")
def k13(spark, d):
    path = scratch_path(spark, "events")
    rows = b.table(spark, d, "events")
    writers.event_rows(rows, c("event_id"), c("event_type"), ["user_id", "value"]).write.text(path)
    return spark.read.schema("time bigint, event string, user_id bigint, value double").json(path)


@query("K14_history", "SELECT DISTINCT o_custkey AS id, '2026-01-01T00:00:00Z' AS last_updated FROM orders")
def k14(spark, d):
    path = scratch_path(spark, "history")
    writers.history_document(b.table(spark, d, "orders"), "o_custkey", "2026-01-01T00:00:00Z").write.parquet(path)
    return spark.read.parquet(path)


@query("K15_snapshot", f"WITH {b.PROMPTS_SQL} SELECT id, video, prompt FROM prompts")
def k15(spark, d):
    path = scratch_path(spark, "run")
    writers.write_snapshot(b.prompts(spark, d).select("id", "video", "prompt"), path)
    return spark.read.schema("id string, video string, prompt string").json(f"{path}/manifest_snapshot")


@query(
    "K16_comparison_csv",
    f"""WITH {b.RECORDS2_SQL} SELECT clip_id, coalesce(o.clip_sha256 = t.clip_sha256, false) AS clip_sha256_same, o.caption IS NOT DISTINCT FROM t.caption AS caption_same
    FROM records o FULL JOIN records2 t USING (clip_id)""",
)
def k16(spark, d):
    from clipwarden.operators import compare

    path = scratch_path(spark, "comparison")
    keys = ["clip_sha256", "caption"]
    t = compare.compare_versions(b.records(spark, d), b.records_v2(spark, d), fields=keys)
    compare.comparison_report(t, fields=keys).write.csv(path, header=True)
    return spark.read.schema("clip_id string, clip_sha256_same boolean, caption_same boolean").csv(path, header=True)
