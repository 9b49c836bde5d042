"""Frame kernels against numpy, readers and writers on small files, streams against batches."""

import datetime
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipwarden.operators import frames as fr
from clipwarden.operators.rowmap import map_rows_with_retry
from clipwarden.plans import bindings, join_queries, source_queries
from clipwarden.session import scratch_path
from clipwarden.sinks import writers
from clipwarden.sources import documents, files, manifests, tables
from clipwarden.streaming import streams

SCHEMA = "clip_id string, frame_idx int, height int, width int, channels int, pixels binary"


def frame_table(spark, clips):
    rows = []
    for cid, video in clips.items():
        for i, f in enumerate(video):
            rows.append((cid, i, f.shape[0], f.shape[1], f.shape[2], bytearray(f.tobytes())))
    return spark.createDataFrame(rows, SCHEMA)


def test_frame_metrics_golden(spark):
    video = np.zeros((3, 2, 2, 3), dtype=np.uint8)
    video[2] = 255
    clips = spark.createDataFrame([("c", 24.0)], "clip_id string, fps double")
    p = fr.frame_partials(frame_table(spark, {"c": video}))
    r = fr.clip_metrics(p, clips).first()
    assert (r["duplicate_frame_ratio"], r["temporal_diff_mean"], r["scene_cut_count"], r["high_motion_ratio"]) == (0.5, 0.5, 1, 0.5)
    assert r["temporal_diff_std"] == pytest.approx(0.510754, abs=1e-6)
    assert r["motion_p95"] == pytest.approx(0.95)


def test_frame_metrics_against_numpy(spark):
    rng = np.random.default_rng(0)
    clips = {k: rng.integers(0, 256, (n, 5, 6, 3), dtype=np.uint8) for k, n in (("a", 130), ("b", 7))}
    fps = spark.createDataFrame([("a", 24.0), ("b", 25.0)], "clip_id string, fps double")
    # small blocks, so that neighbours meet across block borders
    p = fr.frame_partials(frame_table(spark, clips), block=16)
    got = {r["clip_id"]: r for r in fr.clip_metrics(p, fps).collect()}
    for cid, video in clips.items():
        v = video.astype(np.float64) / 255.0
        luma = v @ np.array([0.2126, 0.7152, 0.0722])
        d = np.abs(np.diff(v, axis=0))
        pair = d.reshape(len(d), -1).mean(axis=1)
        hist = np.histogram(luma, bins=64, range=(0, 1))[0] / luma.size
        top, low = v.max(axis=3), v.min(axis=3)
        want = {
            "temporal_diff_mean": d.mean(),
            "temporal_diff_std": d.std(ddof=1),
            "motion_p95": np.quantile(pair, 0.95),
            "flicker_luma_std": luma.reshape(len(v), -1).mean(axis=1).std(ddof=1),
            "sharpness_grad_mean": np.abs(np.diff(v, axis=2)).mean() + np.abs(np.diff(v, axis=1)).mean(),
            "entropy_mean": -(hist * np.log2(hist + 1e-12)).sum() / 6,
            "black_pixel_ratio": (v < 0.01).mean(),
            "white_pixel_ratio": (v > 0.99).mean(),
            "luma_std": luma.std(ddof=1),
            "saturation_mean": ((top - low) / np.maximum(top, 1e-6)).mean(),
            "rgb_std_g": v[..., 1].std(ddof=1),
        }
        for k, w in want.items():
            assert got[cid][k] == pytest.approx(w, abs=1e-9), k
    q = {r["clip_id"]: r for r in fr.luma_quantiles(frame_table(spark, clips), bins=40).collect()}
    for cid, video in clips.items():
        luma = video.astype(np.float64) @ np.array([0.2126, 0.7152, 0.0722]) / 255.0
        assert q[cid]["luma_p01"] == pytest.approx(np.percentile(luma, 1), abs=1e-9)


@pytest.mark.parametrize("mode, want", [("drop", None), ("zero", 1.0), ("dup", 1.0)])
def test_single_frame_clips(spark, mode, want):
    p = fr.frame_partials(frame_table(spark, {"c": np.zeros((1, 2, 2, 3), dtype=np.uint8)}))
    clips = spark.createDataFrame([("c", 24.0)], "clip_id string, fps double")
    r = fr.clip_metrics(p, clips, single_frame=mode).first()
    assert (r and r["duplicate_frame_ratio"]) == want


def test_dhash_resizes_by_area():
    img = np.tile(np.arange(18, dtype=np.uint8)[::-1] * 10, (16, 1))[:, :, None]
    assert fr.image_hash(img) == -1  # every left cell is brighter: 64 set bits
    assert fr.image_hash(img[:, ::-1]) == 0


def test_retries_report_failures(spark):
    df = spark.createDataFrame([(1, 2**60 + 1), (2, None)], "id int, big bigint")

    def fn(row):
        return str(row["big"] + 1)

    got = {r["id"]: r for r in map_rows_with_retry(df, fn, 2).collect()}
    assert got[1]["ok"] and got[1]["value"] == str(2**60 + 2) and got[1]["big"] == 2**60 + 1
    assert not got[2]["ok"] and got[2]["attempts"] == 2 and got[2]["error"].startswith("TypeError")


def write_text(spark, name, lines):
    path = scratch_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_line_numbers_over_splits(spark):
    path = write_text(spark, "lines", [f"line {i}" for i in range(1, 4001)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        t = manifests.numbered_lines(spark, path)
        assert t.select("file", F.spark_partition_id()).distinct().count() > 1
        assert t.filter("raw <> concat('line ', line)").count() == 0 and t.count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_missing_files(spark):
    absent = scratch_path(spark, "absent")
    rows, issues = manifests.read_lenient(spark, absent)
    assert rows is None and issues.first()["code"] == "MANIFEST_NOT_FOUND"
    assert manifests.read_rows(spark, absent, "id string", on_missing="empty").count() == 0
    assert documents.read_log_values(spark, absent).count() == 0
    r = documents.read_summary(spark, absent).first()
    assert (r["count"], r["metric"]) == (0, None)
    assert tables.read_history(spark, absent).count() == 0
    assert tables.read_quality(spark, absent).count() == 0


def test_strict_reader(spark):
    good = write_text(spark, "good", ['{"video":"a/b.mp4","prompt":"p"}', '{"id":null,"video":"c.mp4","prompt":""}'])
    assert [r["id"] for r in manifests.read_strict(spark, good).orderBy("line").collect()] == ["b", None]
    with pytest.raises(Exception, match="must contain"):
        manifests.read_strict(spark, write_text(spark, "bad", ['{"video":"a.mp4"}'])).collect()
    with pytest.raises(Exception, match="not valid JSON"):
        manifests.read_strict(spark, write_text(spark, "bad", ["{oops"])).collect()
    with pytest.raises(ValueError):
        manifests.read_strict(spark, write_text(spark, "empty", ["  "]))


def test_failing_reader(spark):
    path = write_text(spark, "bad", ['{"id":"a"}', "{oops"])
    with pytest.raises(Exception):
        manifests.read_rows(spark, path, "id string").collect()
    assert manifests.read_rows(spark, path, "id string", on_bad="skip").filter("id is not null").count() == 1


def test_coerce_numeric_strict(spark):
    df = spark.createDataFrame([("1.5", "x")], "width string, fps string")
    r = tables.coerce_numeric(df).first()
    assert r["width"] is None and r["fps"] is None
    with pytest.raises(Exception, match="not whole"):
        tables.coerce_numeric(df, strict=True).collect()


def test_upstream_video_kinds(spark):
    df = spark.createDataFrame(
        [(0, (None, bytearray(b"x")), " p ", None), (1, ("a\\b.MOV", None), "", "i d"), (2, (None, None), "p", "z")],
        "i int, video struct<path:string,bytes:binary>, prompt string, id string",
    )
    good, bad = tables.prepare_upstream(df, "i")
    assert [tuple(r) for r in good.orderBy("id").collect()] == [
        ("i_d", "videos/i_d.mov", "Video sample i_d."), ("sample_000000", "videos/sample_000000.mp4", "p"),
    ]
    assert [tuple(r) for r in bad.collect()] == [(2, "missing video")]


def test_empty_report_writes_nothing(spark):
    path = scratch_path(spark, "report")
    empty = spark.createDataFrame([], "path string, grade string")
    assert not writers.write_quality_csv(empty, path) and not manifests.path_exists(spark, path)


def test_log_values_types(spark):
    path = write_text(spark, "log", ['{"a": 1, "ok": true, "s": "2", "n": null, "x": NaN, "l": [1]}', "", '{"a": 2.5}'])
    got = sorted((r["line"], r["key"], r["value"]) for r in documents.read_log_values(spark, path).filter("key <> 'x'").collect())
    assert got == [(1, "a", 1.0), (1, "ok", 1.0), (3, "a", 2.5)]
    assert math.isnan(documents.read_log_values(spark, path).filter("key = 'x'").first()["value"])


def test_url_list(spark):
    path = write_text(spark, "urls", ["# c", "", " https://a ", "https://b"])
    assert sorted(r["url"] for r in files.read_urls(spark, path).collect()) == ["https://a", "https://b"]


def test_new_rows_across_batches(spark):
    path = scratch_path(spark, "ids")
    for part in ([1, 2, 2], [2, 3], [1, 4]):
        spark.createDataFrame([(i,) for i in part], "id int").coalesce(1).write.mode("append").parquet(path)
    stream = streams.file_stream(spark, path, "id int", max_files=1)
    out = scratch_path(spark, "out")
    history = spark.createDataFrame([(4,)], "id int")
    streams.run_available(streams.to_batches(streams.new_rows(stream, "id", history), out), scratch_path(spark, "state"))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_overlap_monitor_keeps_state(spark):
    path = scratch_path(spark, "clips")
    batches = [[("k", 0.0, 1), ("k", 100.0, 2)], [("k", 4.4, 3), ("k", 4.5, 4), ("j", 0.0, 5)], [("k", 286.0, 6), ("k", 290.0, 7)]]
    for i, part in enumerate(batches):
        spark.createDataFrame(part, "key string, start double, n int").coalesce(1).write.mode("append").parquet(path)
    stream = streams.file_stream(spark, path, "key string, start double, n int", max_files=1)
    out = scratch_path(spark, "out")
    judged = streams.overlap_monitor(stream, "key", "start", "n", 4.5)
    streams.run_available(streams.to_batches(judged, out), scratch_path(spark, "state"))
    got = {r["arrival"]: r["overlaps"] for r in spark.read.parquet(out).collect()}
    assert got == {1: False, 2: False, 3: True, 4: True, 5: False, 6: False, 7: True}


def _judged(spark, batches, schema, window, **options):
    """Verdicts by arrival, one micro batch and one run after the other."""
    path, out, state = (scratch_path(spark, n) for n in ("clips", "out", "state"))
    for part in batches:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        judged = streams.overlap_monitor(streams.file_stream(spark, path, schema), "key", "start", "n", window, **options)
        streams.run_available(streams.to_batches(judged, out), state)
    return {r["arrival"]: r["overlaps"] for r in spark.read.parquet(out).collect()}


def test_overlap_monitor_against_all_pairs(spark):
    draw = random.Random(5)
    rows = [(draw.choice("ab"), round(draw.uniform(-40, 40), draw.choice([0, 1, 3])), n) for n in range(240)]
    rows[7] = ("a", float("nan"), 7)
    got = _judged(spark, [rows[:90], rows[90:150], rows[150:]], "key string, start double, n long", 0.7, windows_per_bin=4)
    starts = [r for r in rows if r[1] == r[1]]
    assert got == {n: any(k == key and abs(s - q) < 0.7 for k, q, _ in starts[:i]) for i, (key, s, n) in enumerate(starts)}


def test_overlap_writer_against_all_pairs(spark):
    """Equal rows, equal arrivals, borders of cells, null keys and starts; every batch is one plan, not one call per group."""
    draw = random.Random(6)
    starts = [round(draw.uniform(-9, 9), draw.choice([0, 1, 1])) + 0.0 for _ in range(300)] + [0.7 * k for k in range(-20, 20)]
    rows = [(draw.choice(["a", "b", None]), s, n // 2) for n, s in enumerate(starts)]
    rows += [rows[-1], rows[-1], ("a", None, 900), ("a", float("nan"), 901), ("c", 5.0, None), ("c", 5.1, 1000), ("c", 5.0, None)]
    schema, batches = "key string, start double, n long", [rows[:90], rows[90:150], rows[150:]]
    path, out, state = (scratch_path(spark, n) for n in ("clips", "out", "state"))
    want, seen = [], []
    for part in batches:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
        stream = streams.file_stream(spark, path, schema)
        streams.run_available(streams.overlap_monitor_writer(stream, "key", "start", "n", out, 0.7), state)
        good = [r for r in part if r[1] is not None and r[1] == r[1]]
        for key, s, n in sorted(good, key=lambda r: (-1 if r[2] is None else r[2], r[1])):
            want.append((key, s, n, any(k == key and abs(s - q) < 0.7 for k, q in seen)))
            seen.append((key, s))
    got = [tuple(r) for r in spark.read.parquet(f"{out}/rows").select("key", "start", "arrival", "overlaps").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    batch = spark.createDataFrame(rows, schema).withColumnRenamed("n", "arrival")
    plan = streams.judge_starts(batch, spark.createDataFrame([], "key string, cell bigint, low double, high double"), 0.7)
    assert "Pandas" not in plan._jdf.queryExecution().toString()


def test_overlap_monitor_forgets_by_event_time(spark):
    day = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)
    batches = [
        [("k", 10.0, 1, day)],
        [("k", 1000.0, 2, day + datetime.timedelta(days=3))],
        [("k", 11.0, 3, day + datetime.timedelta(days=3)), ("k", 1001.0, 4, day + datetime.timedelta(days=3))],
    ]
    schema = "key string, start double, n long, ts timestamp"
    kept = _judged(spark, batches, schema, 4.5)
    assert kept == {1: False, 2: False, 3: True, 4: True}
    for days, seen in ((1, False), (30, True)):
        got = _judged(spark, batches, schema, 4.5, ts="ts", retention_seconds=86400.0 * days)
        assert got == {1: False, 2: False, 3: seen, 4: True}


def test_content_hashes_of_any_size(spark, tmp_path):
    """Small chunks, files on either side of the bound, empty files, names with spaces; nothing is lost or read twice."""
    want = {}
    for i, size in enumerate((0, 1, 6, 7, 8, 50, 1000)):
        body = bytes((i * 31 + k) % 256 for k in range(size))
        (tmp_path / f"clip {i}%.mp4").write_bytes(body)
        want[f"clip {i}%.mp4"] = hashlib.sha256(body).hexdigest()
    for bound in (0, 7, 8, 10**6):
        got = files.content_hashes(spark, str(tmp_path), stream_from=bound, chunk_bytes=7).collect()
        assert {r["name"]: r["sha256"] for r in got} == want and len(got) == len(want)
    listed = {r["name"]: r["bytes"] for r in files.list_files(spark, str(tmp_path)).collect()}
    assert listed.keys() == want.keys() and listed["clip 0%.mp4"] == 0 and listed["clip 6%.mp4"] == 1000


def test_content_hashes_of_a_file_above_two_gigabytes(spark, tmp_path):
    size = (1 << 31) + 5
    with open(tmp_path / "large.bin", "wb") as out:
        out.truncate(size)  # sparse: takes no room on the disk
    digest, block = hashlib.sha256(), bytes(1 << 20)
    for _ in range(1 << 11):
        digest.update(block)
    digest.update(bytes(5))
    got = files.content_hashes(spark, str(tmp_path)).collect()
    assert [(r["name"], r["sha256"]) for r in got] == [("large.bin", digest.hexdigest())]


def test_new_rows_from_a_table(spark):
    """Nulls, repeats, a history, and a filter of one bitmap that lets nearly everything through."""
    parts = [[1, 2, 2, None], [2, 3, None], [1, 4, *range(100, 9000)]]
    for blocks in (1, 64):
        path, out = scratch_path(spark, "ids"), scratch_path(spark, "out")
        for part in parts:
            spark.createDataFrame([(i,) for i in part], "id int").coalesce(1).write.mode("append").parquet(path)
        stream = streams.file_stream(spark, path, "id int", max_files=1)
        history = spark.createDataFrame([(4,), *((i,) for i in range(100, 20000, 2))], "id int")
        streams.run_available(streams.new_rows_writer(stream, "id", out, history, blocks), scratch_path(spark, "state"))
        got = [r["id"] for r in spark.read.parquet(out).collect()]
        assert len(got) == len(set(got)) and set(got) == {1, 2, 3, None, *range(101, 9000, 2)}


def test_bloom_filter_keeps_all_and_leaves_out_most(spark):
    rows, probe = spark.range(20000), spark.range(0, 20000, 40)
    kept = {r["id"] for r in streams.maybe_in(rows, probe, "id", 16).collect()}
    assert kept >= set(range(0, 20000, 40)) and len(kept) < 600
    assert streams.maybe_in(rows, probe.limit(0), "id").count() == 0


def test_replayed_batch_changes_nothing(spark):
    out = scratch_path(spark, "out")
    spark.createDataFrame([(1,), (2,)], "id int").write.parquet(f"{out}/batch_id=0")
    batch, seen = spark.createDataFrame([(2,), (3,)], "id int"), spark.read.parquet(out)
    for _ in range(2):
        streams.unseen(batch, "id", seen.filter("batch_id < 1")).write.mode("overwrite").parquet(f"{out}/batch_id=1")
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


SF = "/root/testdata/sf0.001"


def _plans(spark, run):
    """Physical plans of what `run` executes, and its result."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    result = run()
    spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
    new = store.executionsList(int(before), int(store.executionsCount() - before))
    return [new.apply(i).physicalPlanDescription() for i in range(new.size())], result


def _names(spark, path):
    files_ = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return [r["path"].rsplit("/", 1)[1] for r in files_.select("path").collect()]


def test_merge_sorts_no_columns_it_replaces(spark, monkeypatch):
    from clipwarden.operators import merge

    seen = []
    whole = merge.unique_ids
    monkeypatch.setattr(merge, "unique_ids", lambda df, *a, **k: seen.append(df.columns) or whole(df, *a, **k))
    records = bindings.records(spark, SF)
    merged = merge.merge_datasets([records, None, records], ["o_orderkey"])
    assert set(merged.columns) == {*records.columns, "dataset_no", "original_id"}
    join_queries.u01(spark, SF)
    assert not {"clip_uri", "first_frame_uri"} & set(seen[0]) and set(seen[1]) == {"o_orderkey", "clip_id", "dataset_no"}


def test_search_pages_are_compressed(spark, monkeypatch):
    landed = scratch_path(spark, "pages")
    monkeypatch.setattr(source_queries, "scratch_path", lambda *_: landed)
    assert source_queries.s14(spark, SF).count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()
    names = [n for n in _names(spark, landed) if n.startswith("part-")]
    assert names and all(n.endswith(".json.gz") for n in names)


def test_reports_are_compressed_and_ordered_narrow(spark):
    """Rows are put in order before they are measured, and only once; the report is the same."""
    plans, path = _plans(spark, lambda: source_queries._quality_csv(spark, SF, F.lit(True)))
    lines = [line for p in plans for line in p.splitlines()]
    # the line above names the columns that are shuffled
    shuffled = [above for above, line in zip(lines, lines[1:]) if line.startswith("Arguments: rangepartitioning")]
    assert 1 <= len(shuffled) <= 2  # the plan before and after adaptive execution of one write
    assert all("l_orderkey" in above and "path" not in above and "reason" not in above for above in shuffled)
    names = [n for n in _names(spark, path) if n.startswith("part-")]
    assert names and all(n.endswith(".csv.gz") for n in names)
    got = spark.read.csv(path, header=True).count()
    assert got == spark.read.parquet(f"{SF}/lineitem.parquet").count()


def test_quarantine_is_not_sorted(spark):
    key, path = "spark.sql.maxConcurrentOutputFileWriters", scratch_path(spark, "routed")
    before = spark.conf.get(key)
    rows = spark.range(3000).select("id", F.element_at(F.array(F.lit("PASS"), F.lit("FAIL"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias("grade"))
    plans, _ = _plans(spark, lambda: writers.write_quarantine(rows, path))
    assert plans and not any("Sort" in p for p in plans) and spark.conf.get(key) == before
    got = {r["id"]: r["route"] for r in spark.read.parquet(path).collect()}
    assert got == {i: "quarantine" if i % 3 == 1 else "kept" for i in range(3000)}


def test_source_dumps_in_splits_without_line_numbers(spark, tmp_path):
    """Files larger than a split, blank ends, empty files; read once, with no join."""
    for name, n in (("a", 400), ("b", 1), ("c", 0)):
        lines = [f'{{"url": "{name}{i}", "title": "{"t" * 50}"}}' for i in range(n)]
        (tmp_path / f"{name}.txt").write_text("\n".join([*lines, "  ", ""]) if n else " \n")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1000")
    try:
        dumps = documents.read_source_dumps(spark, str(tmp_path))
        assert sorted(r["url"] for r in dumps.collect()) == ["a399", "b0"]
        assert "Join" not in dumps._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(key, before)


def test_dumps_land_in_one_folder(spark, monkeypatch):
    landed = scratch_path(spark, "dumps")
    monkeypatch.setattr(source_queries, "scratch_path", lambda *_: landed)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dumps = docs.select(F.floor(F.col("doc_id") / 20)).distinct().count()
    assert source_queries.s15(spark, SF).count() == dumps
    texts = spark.read.text(landed, wholetext=True)
    assert texts.count() == dumps and texts.filter("value NOT LIKE '%}\n  \n'").count() == 0
    assert texts.select(F.sum(F.size(F.split("value", "\n")) - 1)).first()[0] == 2 * docs.count()
    assert "dump=" not in spark.read.text(landed).select("_metadata.file_path").first()[0]


def test_names_by_stem_are_not_filtered_by_an_expression(spark):
    for query in (join_queries.j02, join_queries.j03):
        plan = query(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "isnotnull(regexp_replace" not in plan
