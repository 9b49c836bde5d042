"""Manifest linter: one issue row per broken rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwarden.functions import paths, scores, text
from clipwarden.functions.numbers import fixed_text
from clipwarden.operators.ordered import running_sums
from clipwarden.spec import ISSUE_COLUMNS, ISSUE_STRUCT, VIDEO_EXTENSIONS, LintConfig

# --- Fixed values: severity, message and fix per code, in evaluation order --
# {line} {sample} {path} {suffix} {found} {want} are filled in per row
CODES = {
    "MANIFEST_NOT_FOUND": (
        "ERROR",
        "Manifest file does not exist: {path}",
        "Set the dataset manifest path in config.json to an existing manifest.jsonl file.",
    ),
    "MANIFEST_BAD_JSON": (
        "ERROR",
        "Line {line} is not valid JSON.",
        "Fix the JSON object on this line. Each line must be one complete JSON object.",
    ),
    "MANIFEST_ROW_NOT_OBJECT": (
        "ERROR",
        "Line {line} is not a JSON object.",
        'Each manifest line must look like {"id":"...","video":"...","prompt":"..."}.',
    ),
    "MANIFEST_EMPTY": (
        "ERROR",
        "Manifest contains no usable rows.",
        "Add at least one JSONL row with video and prompt fields.",
    ),
    "MISSING_ID": (
        "WARN",
        "Line {line} has no stable id.",
        "Add an id field so reports and generated samples have stable names.",
    ),
    "MISSING_VIDEO_FIELD": (
        "ERROR",
        "Line {line} has no video path.",
        "Add a video field pointing to an mp4 or other readable video file.",
    ),
    "MISSING_PROMPT_FIELD": (
        "ERROR",
        "Line {line} has no prompt.",
        "Add a prompt/caption describing subject, motion, camera, scene, and lighting.",
    ),
    "PROMPT_TOO_SHORT": (
        "WARN",
        "Prompt on line {line} is very short.",
        "Use a descriptive caption. Mention subject, motion, camera movement, setting, and lighting.",
    ),
    "UNUSUAL_VIDEO_EXTENSION": (
        "WARN",
        "Video extension looks unusual: {suffix}",
        "Use mp4 when possible. If this file is valid, this warning can be ignored.",
    ),
    "VIDEO_NOT_FOUND": (
        "ERROR",
        "Video file was not found: {path}",
        "Fix the video path in manifest.jsonl. Relative paths are resolved from the manifest folder.",
    ),
    "VIDEO_DECODE_FAILED": (
        "ERROR",
        "Could not decode video: {path}",
        "Re-encode the file as a normal H.264 mp4, then update the manifest path if needed.",
    ),
    "TOO_MANY_DECODE_FAILURES": (
        "ERROR",
        "Many videos failed decoding; stopping diagnostics early.",
        "Fix the video paths/codecs before rerunning diagnostics.",
    ),
    "VIDEO_EMPTY": (
        "ERROR",
        "Decoded video has no frames: {path}",
        "Replace or re-export the source video.",
    ),
    "WIDTH_MISMATCH": (
        "WARN",
        "{sample} width is {found}, expected {want}.",
        "Export videos at the target width, or keep allow_resize enabled so the loader resizes consistently.",
    ),
    "HEIGHT_MISMATCH": (
        "WARN",
        "{sample} height is {found}, expected {want}.",
        "Export videos at the target height, or keep allow_resize enabled so the loader resizes consistently.",
    ),
    "ASPECT_RATIO_MISMATCH": (
        "WARN",
        "{sample} aspect ratio differs from target.",
        "Prefer source videos already matching 1280x704 aspect ratio to avoid stretching or cropping artifacts.",
    ),
    "NOT_ENOUGH_FRAMES": (
        "ERROR",
        "{sample} has {found} frames, expected at least {want}.",
        "Use clips with at least the target frame count, or lower num_frames for a smoke test only.",
    ),
    "FRAME_COUNT_MISMATCH": (
        "WARN",
        "{sample} has {found} frames; loader will sample {want}.",
        "For clean comparisons, export every clip at exactly the target frame count.",
    ),
    "FPS_UNKNOWN": (
        "WARN",
        "{sample} FPS metadata is missing.",
        "Re-encode with explicit 24fps metadata.",
    ),
    "FPS_MISMATCH": (
        "WARN",
        "{sample} FPS is {found}, expected {want}.",
        "Re-encode videos at 24fps for consistent temporal motion.",
    ),
    "HIGH_DUPLICATE_FRAME_RATIO": (
        "WARN",
        "{sample} appears to contain many repeated frames.",
        "Remove frozen/duplicate clips, or re-export from the original source at the correct FPS.",
    ),
    "DUPLICATE_ID": (
        "ERROR",
        "Sample id appears {found} times: {sample}",
        "Make every manifest id unique so checkpoints, reports, and generated samples are unambiguous.",
    ),
    "BATCH_SIZE_MEMORY_RISK": (
        "WARN",
        "train_batch_size is {found}; full-resolution video batches can become very large.",
        "Keep train_batch_size at 1 for Wan2.2 5B dataset comparisons unless memory testing proves a larger batch is stable.",
    ),
    "NUM_WORKERS_MEMORY_RISK": (
        "WARN",
        "num_workers is {found}; PyTorch may keep multiple decoded video batches in system RAM.",
        "Use num_workers=0 for the safest large-dataset workflow. Increase only after the first successful full pass.",
    ),
    "PIN_MEMORY_MEMORY_RISK": (
        "WARN",
        "pin_memory is enabled; decoded batches may be duplicated in page-locked system RAM.",
        "Leave pin_memory=false for large video datasets unless the machine has plenty of spare RAM.",
    ),
}


#: A prompt of fewer words is reported as short.
SHORT_PROMPT_WORDS = 6


def _fill(template: str, parts: dict[str, Column]) -> Column:
    """Template text with `{name}` slots replaced by columns."""
    pieces, rest = [], template
    while rest:
        hits = [(rest.find("{" + k + "}"), k) for k in parts if "{" + k + "}" in rest]
        at, key = min(hits) if hits else (len(rest), None)
        if at:
            pieces.append(F.lit(rest[:at]))
        if key:
            pieces.append(F.coalesce(parts[key].cast("string"), F.lit("")))
        rest = rest[at + (len(key) + 2 if key else 0):]
    return F.concat(*pieces)


def issue(
    code: str,
    line: Column | None = None,
    sample: Column | None = None,
    video: Column | None = None,
    value: Column | None = None,
    severity: str | None = None,
    **slots: Column,
) -> Column:
    """One issue struct."""
    level, message, fix = CODES[code]
    null = F.lit(None).cast("string")
    parts = dict(slots)
    if line is not None:
        parts["line"] = line
    if sample is not None:
        parts["sample"] = sample
    return F.struct(
        F.lit(severity or level).alias("severity"),
        F.lit(code).alias("code"),
        _fill(message, parts).alias("message"),
        F.lit(fix).alias("fix"),
        (line if line is not None else F.lit(None)).cast("bigint").alias("line"),
        (sample if sample is not None else null).alias("sample_id"),
        (video if video is not None else null).alias("video"),
        (value.cast("string") if value is not None else null).alias("value"),
    )


def missing_manifest(spark, path: str) -> DataFrame:
    """The single issue of a manifest that is not there."""
    return spark.range(1).select(issue("MANIFEST_NOT_FOUND", path=F.lit(path)).alias("_i")).select("_i.*")


def with_sample_id(rows: DataFrame) -> DataFrame:
    """Id of a row: its id, else the stem of its video, else `row_<line>`."""
    by_line = F.concat(F.lit("row_"), F.col("line").cast("string"))
    by_video = F.when(F.col("has_video"), paths.stem(F.coalesce(F.col("video"), F.lit("None")))).otherwise(by_line)
    return rows.withColumn("sample_id", F.coalesce(F.nullif(F.col("id"), F.lit("")), by_video))


def prepare_rows(rows: DataFrame, base: str) -> DataFrame:
    """Add what several rules look at, so that each is worked out once per row."""
    c = F.col
    named = with_sample_id(rows).withColumn("path", paths.resolve_path(c("video"), base))
    blank = lambda name: text.strip(F.coalesce(c(name), F.lit(""))) == ""
    return named.withColumns(
        {
            "suffix": F.coalesce(paths.suffix(c("path")), F.lit("")),
            "no_id": ~c("has_id") | (c("id").isNotNull() & blank("id")),
            "no_video": blank("video"),
            "words": c("words") if "words" in rows.columns else text.word_count(c("prompt")),
        }
    )


def row_text_rules() -> list[tuple[Column, Column]]:
    """Rules on a row's own fields, in order; later ones apply only to rows with a video."""
    c = F.col
    line, sample, video = c("line"), c("sample_id"), c("video")
    has_video = ~c("no_video")
    return [
        (c("no_id"), issue("MISSING_ID", line, sample)),
        (c("no_video"), issue("MISSING_VIDEO_FIELD", line, sample)),
        (has_video & (c("words") == 0), issue("MISSING_PROMPT_FIELD", line, sample, video)),
        (
            has_video & (c("words") > 0) & (c("words") < SHORT_PROMPT_WORDS),
            issue("PROMPT_TOO_SHORT", line, sample, video, c("prompt")),
        ),
        (
            has_video & ~F.lower(c("suffix")).isin([f".{e}" for e in VIDEO_EXTENSIONS]),
            issue("UNUSUAL_VIDEO_EXTENSION", line, sample, c("path"), suffix=c("suffix")),
        ),
    ]


def _media_rules(cfg: LintConfig) -> list[tuple[Column, Column]]:
    """Rules on the file and its decoded stats, guarded so that earlier failures stop the row."""
    c, t = F.col, cfg.target
    line, sample, path = c("line"), c("sample_id"), c("path")
    has_video = ~c("no_video")
    found = has_video & c("file_found")
    failed = found & c("decode_error").isNotNull()
    decoded = found & ~failed
    empty = decoded & (F.coalesce(c("frames"), F.lit(0)) == 0)
    ok = decoded & ~empty
    size = None if cfg.allow_resize else "ERROR"
    aspect = scores.aspect_error(c("width"), c("height"), t)
    fps = F.coalesce(c("fps"), F.lit(0.0))
    dup = c("duplicate_frame_ratio")

    def at(code: str, value: Column | None = None, sev: str | None = None, **slots: Column) -> Column:
        return issue(code, line, sample, path, value, sev, **slots)

    return [
        (has_video & ~c("file_found"), at("VIDEO_NOT_FOUND", path=path)),
        (failed, at("VIDEO_DECODE_FAILED", c("decode_error"), path=path)),
        (empty, at("VIDEO_EMPTY", path=path)),
        (ok & (c("width") != t.width), at("WIDTH_MISMATCH", c("width"), size, found=c("width"), want=F.lit(t.width))),
        (ok & (c("height") != t.height), at("HEIGHT_MISMATCH", c("height"), size, found=c("height"), want=F.lit(t.height))),
        (ok & (aspect > 0.02), at("ASPECT_RATIO_MISMATCH", fixed_text(aspect, 4).cast("double"))),
        (ok & (c("frames") < t.frames), at("NOT_ENOUGH_FRAMES", c("frames"), found=c("frames"), want=F.lit(t.frames))),
        (ok & (c("frames") > t.frames), at("FRAME_COUNT_MISMATCH", c("frames"), found=c("frames"), want=F.lit(t.frames))),
        (ok & (fps <= 0), at("FPS_UNKNOWN")),
        (
            ok & (fps > 0) & (F.abs(fps - t.fps) > cfg.fps_tolerance),
            at("FPS_MISMATCH", fps, found=fixed_text(fps, 3), want=F.lit(f"{t.fps:.3f}")),
        ),
        (ok & (dup > 0.10), at("HIGH_DUPLICATE_FRAME_RATIO", fixed_text(dup, 4).cast("double"))),
    ]


def _explode_rules(df: DataFrame, rules: list[tuple[Column, Column]]) -> DataFrame:
    # exploded as it is and filtered afterwards: a filter on the array would work out all rules twice
    hits = [F.when(F.coalesce(cond, F.lit(False)), body) for cond, body in rules]
    return df.select(F.explode(F.array(*hits)).alias("_i")).filter("_i is not null").select("_i.*")


def lint_text(rows: DataFrame, base: str) -> DataFrame:
    """Row-local issues that need no file access; also works on a stream."""
    return _explode_rules(prepare_rows(rows, base), row_text_rules())


def lint_manifest(
    rows: DataFrame,
    read_issues: DataFrame,
    files: DataFrame,
    stats: DataFrame,
    base: str,
    cfg: LintConfig = LintConfig(),
) -> DataFrame:
    """All issues of a manifest.

    rows         line, has_id, id, has_video, video, prompt; words if they are counted already (see `scan_manifest`)
    read_issues  issues found while reading
    files        path of each file that exists
    stats        path, width, height, frames, fps, duplicate_frame_ratio, decode_error

    Every row is judged. With `cfg.max_decode_failures` the issue TOO_MANY_DECODE_FAILURES is added where an
    ordered scan would have stopped, and `after_stop` marks the issues of later lines; none is dropped.
    """
    prepared = prepare_rows(rows, base).drop("fields")
    # only short prompts appear in an issue: the others need not travel through the joins
    prepared = prepared.withColumn("prompt", F.when(F.col("words") < SHORT_PROMPT_WORDS, F.col("prompt")))
    joined = (
        prepared.join(files.select("path").distinct().withColumn("_file", F.lit(True)), "path", "left")
        .join(stats, "path", "left")
        .withColumn("file_found", F.coalesce("_file", F.lit(False)))
        .drop("_file")
    )
    row_issues = _explode_rules(joined, row_text_rules() + _media_rules(cfg))
    repeated = (
        joined.groupBy("sample_id")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .select(issue("DUPLICATE_ID", None, F.col("sample_id"), value=F.col("_n"), found=F.col("_n")).alias("_i"))
        .select("_i.*")
    )
    empty = (
        rows.limit(1).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 0")
        .select(issue("MANIFEST_EMPTY").alias("_i")).select("_i.*")
    )
    out = read_issues.select(*ISSUE_COLUMNS)
    for part in (empty, row_issues, repeated, config_issues(rows.sparkSession, cfg)):
        out = out.unionByName(part)
    if cfg.max_decode_failures is None:
        return out
    failures = joined.filter(~F.col("no_video") & F.col("file_found") & F.col("decode_error").isNotNull())
    return mark_after_stop(out, failures.select("line"), cfg.max_decode_failures)


def mark_after_stop(issues: DataFrame, failures: DataFrame, limit: int) -> DataFrame:
    """Add `after_stop` to issues, and the stop itself, given the lines that failed to decode."""
    counted = running_sums(failures, [], ["line"], {"_k": F.lit(1).cast("bigint")})
    stop = counted.filter(F.col("_k") == limit).select(F.col("line").alias("_stop"))  # one row or none
    stopped = stop.select(issue("TOO_MANY_DECODE_FAILURES").alias("_i")).select("_i.*")
    return (
        issues.unionByName(stopped.select(*ISSUE_COLUMNS))
        .join(F.broadcast(stop), F.col("line") > F.col("_stop"), "left")
        .withColumn("after_stop", F.col("_stop").isNotNull())
        .drop("_stop")
    )


def config_issues(spark, cfg: LintConfig) -> DataFrame:
    """Memory warnings that follow from the training settings alone."""
    found = []
    if cfg.train_batch_size > 1:
        found.append(("BATCH_SIZE_MEMORY_RISK", str(cfg.train_batch_size)))
    if cfg.num_workers > 0:
        found.append(("NUM_WORKERS_MEMORY_RISK", str(cfg.num_workers)))
    if cfg.pin_memory:
        found.append(("PIN_MEMORY_MEMORY_RISK", "True"))
    items = [issue(code, value=F.lit(v), found=F.lit(v)) for code, v in found]
    base = spark.range(1)
    if not items:
        return base.filter("false").select(F.lit(None).cast(ISSUE_STRUCT).alias("_i")).select("_i.*")
    return base.select(F.explode(F.array(*items)).alias("_i")).select("_i.*")


def issue_counts(issues: DataFrame) -> DataFrame:
    """Issues per severity and code, with a total per severity (code null)."""
    return issues.rollup("severity", "code").agg(F.count(F.lit(1)).alias("n")).filter("severity is not null")


def duplicate_ids(rows: DataFrame) -> DataFrame:
    return with_sample_id(rows).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def training_gate(issues: DataFrame) -> DataFrame:
    """Error and warning counts and whether training may start."""
    return issues.agg(
        F.count_if(F.col("severity") == "ERROR").alias("error_count"),
        F.count_if(F.col("severity") == "WARN").alias("warning_count"),
        (F.count_if(F.col("severity") == "ERROR") == 0).alias("ok_to_train"),
    )


def require_ok(issues: DataFrame, allow_errors: bool = False) -> None:
    """Raise when the manifest has errors, unless overridden."""
    gate = training_gate(issues).first()
    if not gate["ok_to_train"] and not allow_errors:
        raise RuntimeError(f"manifest has {gate['error_count']} blocking errors")
