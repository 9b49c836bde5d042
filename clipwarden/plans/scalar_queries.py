"""Queries of the scalar functions (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipwarden.functions import numbers, paths, scores, text, urls
from clipwarden.operators import frames as fr
from clipwarden.operators import records as rec
from clipwarden.operators import select
from clipwarden.plans import bindings as b
from clipwarden.plans.registry import query
from clipwarden.sources.tables import coerce_numeric, strip_to_clip_schema

c = F.col
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NWS = WS.replace("[", "[^", 1)

_PATHS = """p AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'a/b/clip_' || page_id || '.mp4'
    WHEN 1 THEN 'a/.hidden' || page_id WHEN 2 THEN '/x/name' || page_id WHEN 3 THEN 'x.' || page_id || '.tar.GZ'
    ELSE url END AS path FROM pages), q AS (SELECT *, regexp_extract(path, '([^/]*)/*$', 1) AS name FROM p)"""


@query(
    "P01_path_parts",
    f"""WITH {_PATHS} SELECT page_id, name,
    CASE WHEN regexp_matches(name, '^.+\\.[^.]+$') THEN regexp_replace(name, '\\.[^.]+$', '') ELSE name END AS stem,
    CASE WHEN regexp_matches(name, '^.+\\.[^.]+$') THEN regexp_extract(name, '(\\.[^.]+)$', 1) ELSE '' END AS suffix FROM q""",
)
def p01(spark, d):
    key = c("page_id").cast("string")
    path = (
        F.when(c("page_id") % 5 == 0, F.concat(F.lit("a/b/clip_"), key, F.lit(".mp4")))
        .when(c("page_id") % 5 == 1, F.concat(F.lit("a/.hidden"), key))
        .when(c("page_id") % 5 == 2, F.concat(F.lit("/x/name"), key))
        .when(c("page_id") % 5 == 3, F.concat(F.lit("x."), key, F.lit(".tar.GZ")))
        .otherwise(c("url"))
    )
    t = b.table(spark, d, "pages").select("page_id", path.alias("path"))
    return t.select(
        "page_id", paths.basename(c("path")).alias("name"), paths.stem(c("path")).alias("stem"),
        paths.suffix(c("path")).alias("suffix"),
    )


@query(
    "P02_resolve_path",
    """SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '/abs/' || source || '/' || doc_id || '.mp4'
    WHEN 1 THEN '/data/set/' || source || '/' || doc_id || '.mp4'
    ELSE '/data/up/' || doc_id || '.mp4' END AS path FROM documents""",
)
def p02(spark, d):
    name = F.concat(c("doc_id").cast("string"), F.lit(".mp4"))
    value = (
        F.when(c("doc_id") % 3 == 0, F.concat(F.lit("/abs/"), c("source"), F.lit("/"), name))
        .when(c("doc_id") % 3 == 1, F.concat(c("source"), F.lit("/"), name))
        .otherwise(F.concat(F.lit("../up/./"), name))
    )
    return b.table(spark, d, "documents").select("doc_id", paths.resolve_path(value, "/data/set").alias("path"))


@query(
    "P03_parse_clip_id",
    f"""WITH {b.CLIPS_SQL} SELECT clip_id, regexp_extract(clip_id, '^clip_(\\d+)_node([0-9.]+)$', 1) AS video_id,
    regexp_extract(clip_id, '^clip_(\\d+)_node([0-9.]+)$', 2)::DOUBLE AS start_sec FROM clips""",
)
def p03(spark, d):
    cid = c("clip_id")
    return b.clips(spark, d).select(
        "clip_id",
        paths.strict(paths.clip_video_id(cid), cid, "clip_id").alias("video_id"),
        paths.strict(paths.clip_start(cid), cid, "clip_id").alias("start_sec"),
    )


@query(
    "P03_parse_clip_id_lenient",
    """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN doc_id::VARCHAR END AS video_id,
    CASE WHEN doc_id % 2 = 0 THEN doc_id + 0.25e0 END AS start_sec FROM documents""",
)
def p03b(spark, d):
    key = c("doc_id").cast("string")
    cid = F.when(c("doc_id") % 2 == 0, F.concat(F.lit("clip_"), key, F.lit("_node"), key, F.lit(".25"))).otherwise(
        F.concat(F.lit("clip_x"), key)
    )
    return b.table(spark, d, "documents").select(
        "doc_id", paths.clip_video_id(cid).alias("video_id"), paths.clip_start(cid).alias("start_sec")
    )


@query(
    "P04_parse_clip_name",
    "SELECT doc_id, '-' || source || '_' || lang AS src, doc_id AS seconds FROM documents",
)
def p04(spark, d):
    path = F.concat(
        F.lit("clips/-"), c("source"), F.lit("_"), c("lang"), F.lit("_"),
        F.lpad(c("doc_id").cast("string"), 12, "0"), F.lit(".mp4"),
    )
    return b.table(spark, d, "documents").select(
        "doc_id", paths.name_source(path).alias("src"), paths.name_seconds(path).alias("seconds")
    )


@query(
    "P05_provider_source",
    f"""WITH {b.CLIPS_SQL} SELECT DISTINCT 'pexels_' || l_orderkey AS source_video_id,
    'https://www.pexels.com/video/' || l_orderkey || '/' AS source_video_url FROM clips""",
)
def p05(spark, d):
    vid = paths.clip_video_id(c("clip_id"))
    return (
        b.clips(spark, d)
        .select(
            urls.provider_source_id(vid).alias("source_video_id"), urls.provider_source_url(vid).alias("source_video_url")
        )
        .distinct()
    )


@query(
    "P06_clip_records",
    """WITH k AS (SELECT doc_id, 'clip_' || doc_id || '_node' || (doc_id % 60) || '.50' AS id, text FROM documents)
    SELECT id AS clip_id, 'clips/' || id || '.mp4' AS clip_uri, sha256(text) AS clip_sha256,
    'frames/' || id || '.jpg' AS first_frame_uri, sha256(id) AS first_frame_sha256,
    'pexels_' || doc_id AS source_video_id, doc_id % 60 + 0.5e0 AS clip_start_sec, 121 / 24e0 AS duration_sec,
    1280::BIGINT AS width, 704::BIGINT AS height, 24e0 AS fps, 121::BIGINT AS num_frames,
    'https://www.pexels.com/video/' || doc_id || '/' AS source_video_url, text AS caption FROM k""",
)
def p06(spark, d):
    key = c("doc_id").cast("string")
    rows = b.table(spark, d, "documents").select(
        F.concat(F.lit("clip_"), key, F.lit("_node"), (c("doc_id") % 60).cast("string"), F.lit(".50")).alias("id"),
        c("text").alias("prompt"),
        F.sha2("text", 256).alias("clip_sha256"),
    )
    return rec.build_records(rows.withColumn("first_frame_sha256", F.sha2("id", 256)))


_URLS = """u AS (SELECT page_id, CASE page_id % 7 WHEN 0 THEN 'https://youtu.be/ID' || page_id || '?t=1'
    WHEN 1 THEN 'https://m.youtube.com/shorts/ID' || page_id WHEN 2 THEN 'https://WWW.youtube.com/watch?v=ID' || page_id || '&t=2'
    WHEN 3 THEN ' https://x.org/a' || page_id || ' ' WHEN 4 THEN 'https://youtube.com/embed/ID' || page_id || '/'
    WHEN 5 THEN 'https://youtube.com/watch?v=&id=' || page_id ELSE url END AS url FROM pages), h AS (
    SELECT *, lower(regexp_extract(trim(url), '^[a-z]+://([^/?#:]+)', 1)) AS host,
      regexp_extract(trim(url), '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path,
      regexp_extract(trim(url), '[?&]v=([^&#]*)', 1) AS v FROM u)"""


def page_links(spark, d):
    key = c("page_id").cast("string")
    mod = c("page_id") % 7
    url = (
        F.when(mod == 0, F.concat(F.lit("https://youtu.be/ID"), key, F.lit("?t=1")))
        .when(mod == 1, F.concat(F.lit("https://m.youtube.com/shorts/ID"), key))
        .when(mod == 2, F.concat(F.lit("https://WWW.youtube.com/watch?v=ID"), key, F.lit("&t=2")))
        .when(mod == 3, F.concat(F.lit(" https://x.org/a"), key, F.lit(" ")))
        .when(mod == 4, F.concat(F.lit("https://youtube.com/embed/ID"), key, F.lit("/")))
        .when(mod == 5, F.concat(F.lit("https://youtube.com/watch?v=&id="), key))
        .otherwise(c("url"))
    )
    return b.table(spark, d, "pages").select("page_id", url.alias("url"))


@query(
    "P07_canonical_source_key",
    f"""WITH {_URLS} SELECT page_id, coalesce('https://www.youtube.com/watch?v=' || CASE
      WHEN host = 'youtu.be' THEN nullif(trim(path, '/'), '')
      WHEN host = 'youtube.com' OR host LIKE '%.youtube.com' THEN coalesce(nullif(trim(v), ''),
        nullif(regexp_extract(path, '^/+(shorts|embed|v)/+([^/]+)', 2), '')) END, trim(url)) AS source_key FROM h""",
)
def p07(spark, d):
    return page_links(spark, d).select("page_id", urls.canonical_source_key(c("url")).alias("source_key"))


@query(
    "P08_timestamp_link",
    "SELECT doc_id, 'https://www.youtube.com/watch?v=' || source || '&t=' || n_chars || 's' AS link FROM documents",
)
def p08(spark, d):
    return b.table(spark, d, "documents").select(
        "doc_id", urls.timestamp_link(c("source"), c("n_chars")).alias("link")
    )


_CLOCK = """CASE WHEN {s} >= 3600 THEN printf('%d:%02d:%02d', {s} // 3600, {s} % 3600 // 60, {s} % 60)
    ELSE printf('%d:%02d', {s} // 60, {s} % 60) END"""


@query(
    "P09_timestamps",
    f"""WITH s AS (SELECT event_id, event_id * 7 AS a, CAST(round_even(value * 100e0, 0) AS BIGINT) AS x FROM events)
    SELECT event_id, {_CLOCK.format(s="a")} AS clock,
    CASE WHEN x < 60 THEN x::VARCHAR ELSE {_CLOCK.format(s="x")} END AS cue FROM s""",
)
def p09(spark, d):
    return b.table(spark, d, "events").select(
        "event_id", text.clock_text(c("event_id") * 7).alias("clock"),
        text.cue_text(c("value") * F.lit(100.0)).alias("cue"),
    )


@query(
    "P10_clean_id",
    r"""WITH s AS (SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN NULL WHEN doc_id % 10 = 1 THEN '__' ELSE text END AS t,
      'sample_' || lpad(doc_id::VARCHAR, greatest(6, length(doc_id::VARCHAR))::INT, '0') AS fb FROM documents)
    SELECT doc_id, coalesce(nullif(trim(regexp_replace(coalesce(nullif(t, ''), fb), '[^\p{L}\p{N}_.\-]', '_', 'g'), '_'), ''), fb) AS sample_id FROM s""",
)
def p10(spark, d):
    value = F.when(c("doc_id") % 10 == 0, F.lit(None)).when(c("doc_id") % 10 == 1, "__").otherwise(c("text"))
    return b.table(spark, d, "documents").select(
        "doc_id", paths.clean_id(value, paths.sample_fallback(c("doc_id"))).alias("sample_id")
    )


@query(
    "P11_slug",
    r"SELECT doc_id, lower(trim(regexp_replace(text, '[^A-Za-z0-9_.\-]+', '_', 'g'), '_')) AS slug FROM documents",
)
def p11(spark, d):
    return b.table(spark, d, "documents").select("doc_id", paths.slug(c("text")).alias("slug"))


@query(
    "P12_video_names",
    """SELECT page_id, CASE page_id % 3 WHEN 0 THEN '.mov' WHEN 1 THEN '.mp4' ELSE '.webm' END AS ext,
    CASE WHEN page_id % 4 = 0 THEN 'Video sample ' || page_id || '.' ELSE 'p' || page_id END AS prompt,
    'a/b/' || page_id AS path FROM pages""",
)
def p12(spark, d):
    key = c("page_id").cast("string")
    tail = F.when(c("page_id") % 3 == 0, ".MOV?x=1.avi").when(c("page_id") % 3 == 1, "").otherwise(".webm#t")
    link = F.concat(F.lit("https://h.org/v"), key, tail)
    prompt = F.when(c("page_id") % 8 == 0, F.lit(None)).when(c("page_id") % 4 == 0, "  ").otherwise(
        F.concat(F.lit(" p"), key, F.lit(" "))
    )
    return b.table(spark, d, "pages").select(
        "page_id", urls.extension_of(link).alias("ext"), text.prompt_or_default(prompt, key).alias("prompt"),
        paths.forward_slashes(F.concat(F.lit("a\\b\\"), key)).alias("path"),
    )


_LABEL = """CASE WHEN h >= 2160 THEN '4k' WHEN h >= 1440 THEN '2k' WHEN h >= 1080 THEN '1080p' WHEN h >= 720 THEN '720p'
    ELSE h || 'p' END"""


@query(
    "P13_resolution_label",
    f"WITH s AS (SELECT p_partkey, p_size * 60 AS h FROM part) SELECT p_partkey, {_LABEL} AS label FROM s",
)
def p13(spark, d):
    return b.table(spark, d, "part").select("p_partkey", text.resolution_label(c("p_size") * 60).alias("label"))


@query(
    "P14_build_prompt",
    f"""WITH s AS (SELECT p_partkey, p_size * 60 AS h, p_name || ' ' || p_type AS q FROM part)
    SELECT p_partkey, 'A ' || q || ' clip, ' || {_LABEL} || ' (' || h || '), ' || q AS prompt FROM s""",
)
def p14(spark, d):
    q = F.concat(F.lit("  "), c("p_name"), F.lit(" \t "), c("p_type"), F.lit(" "))
    return b.table(spark, d, "part").select(
        "p_partkey",
        text.build_prompt("A {description} clip, {resolution} ({height}), {query}", q, c("p_size") * 60).alias("prompt"),
    )


@query(
    "P15_prompt_sizes",
    f"SELECT doc_id, len(regexp_extract_all(text, '{NWS}+')) AS words, length(text) AS chars FROM documents",
)
def p15(spark, d):
    return b.table(spark, d, "documents").select(
        "doc_id", text.word_count(c("text")).cast("bigint").alias("words"), text.char_count(c("text")).cast("bigint").alias("chars")
    )


@query(
    "P16_caption_length",
    "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 4 ELSE length(text) END::BIGINT AS caption_length FROM documents",
)
def p16(spark, d):
    caption = F.when(c("doc_id") % 5 != 0, c("text"))
    return b.table(spark, d, "documents").select(
        "doc_id", text.caption_length(caption).cast("bigint").alias("caption_length")
    )


@query(
    "P17_caption_or_prompt",
    f"""WITH s AS (SELECT doc_id, source, CASE WHEN doc_id % 4 = 0 THEN '  ' ELSE '  ' || text || ' ' END AS t FROM documents)
    SELECT doc_id, coalesce(nullif(regexp_replace(regexp_replace(t, '^{WS}+', ''), '{WS}+$', ''), ''), source) AS prompt FROM s""",
)
def p17(spark, d):
    new = F.when(c("doc_id") % 4 == 0, "  ").otherwise(F.concat(F.lit("  "), c("text"), F.lit(" ")))
    return b.table(spark, d, "documents").select("doc_id", text.caption_or(new, c("source")).alias("prompt"))


_DUR = "CASE WHEN o_orderkey % 10 = 0 THEN 0e0 ELSE o_totalprice / 10000e0 END"


def _durations(spark, d):
    dur = F.when(c("o_orderkey") % 10 == 0, F.lit(0.0)).otherwise(c("o_totalprice") / F.lit(10000.0))
    return b.table(spark, d, "orders").select("o_orderkey", dur.alias("duration"))


@query(
    "P18_keyframe_plan",
    f"""WITH s AS (SELECT o_orderkey, {_DUR} AS dur FROM orders), n AS (SELECT o_orderkey,
      greatest(CASE WHEN dur > 0 THEN CAST(round_even(dur * 24e0, 0) AS BIGINT) ELSE 121 END, 121) AS n FROM s)
    SELECT o_orderkey, n AS total, array_to_string(list_transform([0, 1, 2, 3], lambda i: CAST(round_even(i::DOUBLE * (n - 1) / 3e0, 0) AS BIGINT)), ',') AS picks FROM n""",
)
def p18(spark, d):
    total = scores.plan_total_frames(c("duration"), F.lit(24.0))
    return _durations(spark, d).select("o_orderkey", total.alias("total")).withColumn(
        "picks", F.array_join(scores.keyframe_plan(c("total"), 4).cast("array<string>"), ",")
    )


@query(
    "P19_uniform_frames",
    """WITH s AS (SELECT o_orderkey, o_orderkey % 200 + 1 AS n FROM orders)
    SELECT o_orderkey, CASE WHEN n = 8 THEN '0,1,2,3,4,5,6,7' ELSE array_to_string(list_transform(range(8),
      lambda i: least(CAST(round_even(i::DOUBLE * ((n - 1)::DOUBLE / 7e0), 0) AS BIGINT), n - 1)), ',') END AS picks FROM s""",
)
def p19(spark, d):
    t = b.table(spark, d, "orders").select("o_orderkey", (c("o_orderkey") % 200 + 1).alias("n"))
    return t.select("o_orderkey", F.array_join(scores.uniform_frames(c("n"), 8).cast("array<string>"), ",").alias("picks"))


@query(
    "P20_clip_sampling_plan",
    f"""WITH s AS (SELECT o_orderkey, greatest(0e0, {_DUR} - 5.0e0) AS room FROM orders), k AS (
      SELECT o_orderkey, room, unnest([1, 2, 3]) AS k FROM s WHERE room >= 0.01e0), u AS (
      SELECT o_orderkey, round(('0x' || substring(md5('42:' || o_orderkey || ':' || k), 1, 13))::BIGINT / 4503599627370496e0 * room, 2) AS st FROM k)
    SELECT DISTINCT o_orderkey, printf('clip_%d_node%.2f', o_orderkey, st) AS clip_id, st AS clip_start_sec FROM u""",
)
def p20(spark, d):
    return select.clip_sampling_plan(_durations(spark, d), "o_orderkey", "duration", 3, 5.0)


@query(
    "P21_sample_window",
    f"""WITH s AS (SELECT o_orderkey, {_DUR} * 10e0 AS dur FROM orders), l AS (SELECT *, least(20e0, dur * 0.25e0) AS len FROM s)
    SELECT o_orderkey, CASE WHEN dur > 0 THEN least(dur * 0.4e0, greatest(dur * 0.1e0, dur / 2e0 - len / 2e0)) END AS sample_start,
    CASE WHEN dur > 0 THEN len END AS sample_duration FROM l""",
)
def p21(spark, d):
    t = _durations(spark, d).withColumn("duration", c("duration") * 10.0)
    return t.select("o_orderkey", *[v.alias(k) for k, v in scores.sample_window(c("duration")).items()])


@query(
    "P22_conformance",
    f"WITH {b.SCORED_SQL} SELECT {', '.join(b.ROW_ORDER)}, round(conformance_score, 9) AS conformance_score FROM scored",
)
def p22(spark, d):
    conf = scores.conformance(
        c("source_width"), c("source_height"), c("source_frames"), c("source_fps"), c("duplicate_frame_ratio")
    )
    return b.clips(spark, d).select(*b.ROW_ORDER, F.round(conf, 9).alias("conformance_score"))


@query(
    "P23_spec_errors",
    f"""WITH {b.CLIPS_SQL} SELECT {', '.join(b.ROW_ORDER)}, source_width - 1280 AS width_error_px, source_height - 704 AS height_error_px,
    source_frames - 121 AS frame_error, CASE WHEN source_fps > 0 THEN source_fps - 24e0 ELSE 0e0 END AS fps_error,
    round(abs(source_width::DOUBLE / source_height - 1280e0 / 704e0), 9) AS aspect_error,
    CASE WHEN source_fps > 0 THEN round(source_frames / source_fps, 9) ELSE 0e0 END AS duration_seconds FROM clips""",
)
def p23(spark, d):
    errors = scores.spec_errors(c("source_width"), c("source_height"), c("source_frames"), c("source_fps"))
    for k in ("aspect_error", "duration_seconds"):
        errors[k] = F.round(errors[k], 9)
    return b.clips(spark, d).select(*b.ROW_ORDER, *[v.alias(k) for k, v in errors.items()])


@query(
    "P24_timelapse",
    f"WITH {b.SCORED_SQL} SELECT {', '.join(b.ROW_ORDER)}, round(timelapse_score, 9) AS timelapse_score FROM scored",
)
def p24(spark, d):
    lapse = scores.timelapse(
        c("duplicate_frame_ratio"), c("high_motion_ratio"), c("temporal_diff_mean"), c("temporal_diff_std")
    )
    return b.clips(spark, d).select(*b.ROW_ORDER, F.round(lapse, 9).alias("timelapse_score"))


# bits of an 8 x 8 frame: 7 comparisons in each of 8 rows
HASH_SQL = """hashes AS (SELECT clip_id, frame_idx, list_reduce(list_transform(range(0, 56),
      lambda i: CASE WHEN v[(i // 7) * 8 + i % 7 + 1] > v[(i // 7) * 8 + i % 7 + 2] THEN 1::BIGINT ELSE 0::BIGINT END),
      lambda a, x: a * 2 + x) AS dhash FROM px)"""


@query("P28_dhash", f"WITH {b.FRAMES_SQL}, {HASH_SQL} SELECT * FROM hashes")
def p28(spark, d):
    return fr.frame_hashes(b.gray_frames(spark, d), cols=7, rows=8)


@query("P28_dhash_of_arrays", f"WITH {b.FRAMES_SQL}, {HASH_SQL} SELECT * FROM hashes")
def p28b(spark, d):
    t = b.table(spark, d, "embeddings").select(*b.frame_keys(), b.frame_values().alias("v"))
    return t.select("clip_id", "frame_idx", fr.array_dhash(c("v"), 7, 8).alias("dhash"))


@query(
    "P29_hash_distance",
    f"""WITH {b.FRAMES_SQL}, {HASH_SQL} SELECT a.clip_id, a.frame_idx, bit_count(xor(a.dhash, n.dhash))::INTEGER AS hamming,
    round((bit_count(xor(a.dhash, n.dhash)) + bit_count(xor(a.dhash, f.dhash)) + bit_count(xor(n.dhash, f.dhash))) / 3e0, 9) AS mean_hamming
    FROM hashes a JOIN hashes n ON a.clip_id = n.clip_id AND n.frame_idx = a.frame_idx + 1
    JOIN hashes f ON f.clip_id = a.clip_id AND f.frame_idx = 0""",
)
def p29(spark, d):
    from clipwarden.operators.dedup import hamming, mean_hamming

    h = fr.frame_hashes(b.gray_frames(spark, d), cols=7, rows=8)
    nxt = h.select("clip_id", (c("frame_idx") - 1).alias("frame_idx"), c("dhash").alias("n"))
    head = h.filter("frame_idx = 0").select("clip_id", c("dhash").alias("f"))
    return h.join(nxt, ["clip_id", "frame_idx"]).join(head, "clip_id").select(
        "clip_id", "frame_idx", hamming(c("dhash"), c("n")).alias("hamming"),
        F.round(mean_hamming([(c("dhash"), c("n")), (c("dhash"), c("f")), (c("n"), c("f"))]), 9).alias("mean_hamming"),
    )


@query(
    "P30_luma",
    f"""WITH {b.RGB_SQL} SELECT clip_id, frame_idx, round(sum(luma)::DOUBLE / (64 * 2550000e0), 9) AS luma_mean FROM rgb GROUP BY ALL""",
)
def p30(spark, d):
    p = fr.frame_partials(b.rgb_frames(spark, d))
    return p.select(
        "clip_id", "frame_idx", F.round(c("luma_sum") / (c("n_pixels") * F.lit(fr.LUMA_UNIT)), 9).alias("luma_mean")
    )


@query("P31_sha256", "SELECT doc_id, sha256(text) AS sha256 FROM documents")
def p31(spark, d):
    return b.table(spark, d, "documents").select("doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("sha256"))


_TEXTUAL = """CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'n/a' WHEN 2 THEN ' ' || o_custkey || ' ' ELSE o_custkey || '.0' END"""


@query(
    "P32_coerce_numeric",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 >= 2 THEN o_custkey END AS width,
    CASE WHEN o_orderkey % 4 >= 2 THEN o_custkey::DOUBLE END AS fps, o_totalprice AS duration_sec FROM orders""",
)
def p32(spark, d):
    mod, key = c("o_orderkey") % 4, c("o_custkey").cast("string")
    raw = F.when(mod == 0, "").when(mod == 1, "n/a").when(mod == 2, F.concat(F.lit(" "), key, F.lit(" "))).otherwise(
        F.concat(key, F.lit(".0"))
    )
    t = b.table(spark, d, "orders").select(
        "o_orderkey", raw.alias("width"), raw.alias("fps"), c("o_totalprice").alias("duration_sec")
    )
    return coerce_numeric(t)


@query("P33_strip_schema", f"WITH {b.RECORDS_SQL} SELECT fps, clip_id, caption FROM records")
def p33(spark, d):
    return strip_to_clip_schema(b.records(spark, d).select("fps", "o_orderkey", "clip_id", "o_custkey", "caption"))


_MAN = """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN '/ds/clips/' || doc_id || '.mp4' WHEN 2 THEN 'clips/' || doc_id || '.mp4'
    ELSE '/old/x/' || doc_id || '.mp4' END AS video FROM documents"""


def _moved_manifest(spark, d):
    mod, name = c("doc_id") % 4, F.concat(c("doc_id").cast("string"), F.lit(".mp4"))
    video = (
        F.when(mod == 0, "")
        .when(mod == 1, F.concat(F.lit("/ds/clips/"), name))
        .when(mod == 2, F.concat(F.lit("clips/"), name))
        .otherwise(F.concat(F.lit("/old/x/"), name))
    )
    return b.table(spark, d, "documents").select("doc_id", video.alias("video"))


@query(
    "P34_rewrite_paths",
    """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '' ELSE '/ds/clips/' || doc_id || '.mp4' END AS video,
    CASE doc_id % 4 WHEN 0 THEN 'empty' WHEN 1 THEN 'correct' ELSE 'fixed' END AS path_state FROM documents""",
)
def p34(spark, d):
    return rec.rewrite_paths(_moved_manifest(spark, d), "/ds")


@query(
    "A23_rewrite_counts",
    """SELECT count(*) FILTER (doc_id % 4 >= 2) AS fixed, count(*) FILTER (doc_id % 4 = 1) AS already_correct, count(*) AS rows FROM documents""",
)
def a23(spark, d):
    return rec.rewrite_counts(rec.rewrite_paths(_moved_manifest(spark, d), "/ds"))


@query(
    "P35_renumber",
    f"""WITH {b.RECORDS_SQL}, n AS (SELECT *, row_number() OVER (ORDER BY clip_id) AS i FROM records), k AS (
      SELECT *, 'motion_' || CASE WHEN length(i::VARCHAR) >= 4 THEN i::VARCHAR ELSE lpad(i::VARCHAR, 4, '0') END AS nid FROM n)
    SELECT o_orderkey, clip_id AS old_id, nid AS clip_id, 'clips/' || nid || '.mp4' AS clip_uri, 'frames/' || nid || '.jpg' AS first_frame_uri FROM k""",
)
def p35(spark, d):
    from clipwarden.operators.merge import renumber

    t = b.records(spark, d).select("o_orderkey", "clip_id", "clip_uri", "first_frame_uri")
    return renumber(t, "motion", ["clip_id"])


@query(
    "P36_field_equal",
    """SELECT event_id, CASE event_id % 5 WHEN 0 THEN true WHEN 1 THEN value = round(value) WHEN 2 THEN true WHEN 3 THEN false ELSE false END AS same FROM events""",
)
def p36(spark, d):
    mod = c("event_id") % 5
    nan = F.lit(float("nan")).cast("string")
    left = (
        F.when(mod == 0, nan)
        .when(mod == 1, F.round("value").cast("bigint").cast("string"))
        .when(mod == 2, c("event_type"))
        .when(mod == 3, c("event_type"))
    )
    right = (
        F.when(mod == 0, F.lit(None).cast("string"))
        .when(mod == 1, c("value").cast("string"))
        .when(mod == 2, c("event_type"))
        .when(mod == 3, F.concat(c("event_type"), F.lit("!")))
        .otherwise(c("event_type"))
    )
    return b.table(spark, d, "events").select("event_id", numbers.field_equal(left, right).alias("same"))


@query(
    "P37_issue_categories",
    f"""WITH {b.GRADED_SQL} SELECT {', '.join(b.ROW_ORDER)}, CASE WHEN grade <> 'FAIL' THEN '' ELSE concat_ws(',',
      CASE WHEN contains(reason, 'duplicate') THEN 'DUPLICATE' END, CASE WHEN contains(reason, 'static') THEN 'STATIC' END,
      CASE WHEN contains(reason, 'timelapse') THEN 'TIMELAPSE' END, CASE WHEN contains(reason, 'scene_cuts') THEN 'SCENE_CUT' END,
      CASE WHEN contains(reason, 'clipping') THEN 'CLIPPING' END, CASE WHEN contains(reason, 'conformance') THEN 'LOW_CONFORMANCE' END) END AS categories FROM graded""",
)
def p37(spark, d):
    kinds = text.issue_categories(c("reason"), c("grade"))
    return b.graded(spark, d).select(*b.ROW_ORDER, F.array_join(kinds, ",").alias("categories"))


@query(
    "P38_primary_category",
    f"WITH {b.GRADED_SQL} SELECT {', '.join(b.ROW_ORDER)}, trim(split_part(split_part(reason, '=', 1), ';', 1)) AS category FROM graded",
)
def p38(spark, d):
    return b.graded(spark, d).select(*b.ROW_ORDER, text.primary_category(c("reason")).alias("category"))


@query(
    "P39_dashboard_scores",
    f"""WITH {b.SCORED_SQL}, m AS (SELECT source, avg(conformance_score) AS cf, avg(temporal_diff_mean) AS mo, avg(temporal_diff_std) AS sh,
      avg(high_motion_ratio) AS en, avg(duplicate_frame_ratio) AS du FROM scored GROUP BY source)
    SELECT source, round(cf, 6) AS conformance, round(least(mo * 8e0, 1e0), 6) AS motion, round(least(sh * 12e0, 1e0), 6) AS sharpness,
    round(en, 6) AS entropy, round(greatest(0e0, 1e0 - du), 6) AS low_duplicates, round(least(en * 40e0 / 40e0, 1e0), 6) AS first_frame_psnr_40,
    round(least(mo * 10e0, 1e0), 6) AS gen_motion, round(greatest(0e0, 1e0 - du), 6) AS low_blank, round(least(cf * 4e0 / 8e0, 1e0), 6) AS speed FROM m""",
)
def p39(spark, d):
    from clipwarden.operators.grade import score_clips

    m = score_clips(b.clips(spark, d)).groupBy("source").agg(
        F.avg("conformance_score").alias("cf"), F.avg("temporal_diff_mean").alias("mo"),
        F.avg("temporal_diff_std").alias("sh"), F.avg("high_motion_ratio").alias("en"),
        F.avg("duplicate_frame_ratio").alias("du"),
    )
    bars = scores.dataset_bars(c("cf"), c("mo"), c("sh"), c("en"), c("du"))
    gen = scores.inference_bars(c("en") * 40.0, c("mo"), c("du"), c("cf") * 4.0)
    gen["gen_motion"] = gen.pop("motion")
    return m.select("source", *[F.round(v, 6).alias(k) for k, v in {**bars, **gen}.items()])


@query(
    "P40_uri_templates",
    "SELECT o_orderkey, 'clips/o' || o_orderkey || '.mp4' AS clip_uri, 'frames/o' || o_orderkey || '.jpg' AS first_frame_uri FROM orders",
)
def p40(spark, d):
    cid = F.concat(F.lit("o"), c("o_orderkey").cast("string"))
    return b.table(spark, d, "orders").select(
        "o_orderkey", paths.clip_uri(cid).alias("clip_uri"), paths.frame_uri(cid).alias("first_frame_uri")
    )
