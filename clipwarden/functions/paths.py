"""File-path and identifier columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    """Last path component; trailing slashes do not count, `.` and `..` keep their meaning."""
    # the regular expression only runs where a path ends in a slash or in `/.`
    odd = path.endswith("/") | path.endswith("/.")
    trimmed = F.when(odd, F.regexp_replace(path, r"(/\.?)+$", "")).otherwise(path)
    return F.substring_index(trimmed, "/", -1)


def stem(path: Column) -> Column:
    """Base name without its last suffix; a leading or trailing dot starts no suffix."""
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]+$", "")


def suffix(path: Column) -> Column:
    """Last suffix with its dot, or an empty string."""
    return F.regexp_extract(basename(path), r"(?<=.)(\.[^.]+)$", 1)


def resolve_path(value: Column, base: Column | str) -> Column:
    """Absolute paths stay; others are joined to `base` and normalised."""
    root = F.lit(base) if isinstance(base, str) else base
    joined = F.when(value.startswith("/"), value).otherwise(
        F.concat(F.rtrim(root, F.lit("/")), F.lit("/"), value)
    )
    parts = F.filter(F.split(joined, "/"), lambda p: ~p.isin("", "."))
    up = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, p: F.when(
            p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))
        ).otherwise(F.concat(acc, F.array(p))),
    )
    plain = ~joined.rlike(r"(^|/)\.{0,2}(/|$)") | joined.rlike(r"^/([^/.][^/]*/?)+$")
    return F.when(F.substring(joined, 1, 1) != "/", joined).otherwise(
        F.when(plain & ~joined.endswith("/"), joined).otherwise(
            F.concat(F.lit("/"), F.array_join(up, "/"))
        )
    )


def clip_video_id(clip_id: Column) -> Column:
    """The source number of `clip_<number>_node<start>`, null when it does not parse."""
    return F.nullif(F.regexp_extract(clip_id, r"^clip_(\d+)_node([0-9.]+)$", 1), F.lit(""))


def clip_start(clip_id: Column) -> Column:
    """The start second of `clip_<number>_node<start>`, null when it does not parse."""
    text = F.regexp_extract(clip_id, r"^clip_(\d+)_node([0-9.]+)$", 2)
    return F.nullif(text, F.lit("")).try_cast("double")


def strict(value: Column, source: Column, what: str) -> Column:
    """Fail the query where `value` is null, naming the offending `source`."""
    return F.when(value.isNotNull(), value).otherwise(
        F.raise_error(F.concat(F.lit(f"cannot parse {what}: "), F.coalesce(source, F.lit("null"))))
    )


def name_source(path: Column) -> Column:
    """Source part of `<source>_<seconds>.<ext>`; the source may contain underscores."""
    return F.regexp_extract(stem(path), r"^(.*)_([^_]*)$", 1)


def name_seconds(path: Column) -> Column:
    """Seconds part of `<source>_<seconds>.<ext>`."""
    return F.regexp_extract(stem(path), r"^(.*)_([^_]*)$", 2).try_cast("bigint")


def clean_id(value: Column, fallback: Column) -> Column:
    """Keep letters, digits, `-`, `_` and `.`; other characters become `_`; never empty."""
    text = F.coalesce(F.nullif(value.cast("string"), F.lit("")), fallback)
    safe = F.regexp_replace(text, r"[^\p{L}\p{N}_.\-]", "_")
    return F.coalesce(F.nullif(F.trim(safe, F.lit("_")), F.lit("")), fallback)


def sample_fallback(index: Column) -> Column:
    """Default id of the row at a 0-based position."""
    return padded_name("sample", index, 6)


def slug(value: Column) -> Column:
    """Lower-case file-name form of a label."""
    return F.lower(F.trim(F.regexp_replace(value, r"[^A-Za-z0-9_.\-]+", "_"), F.lit("_")))


def forward_slashes(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def clip_uri(clip_id: Column) -> Column:
    return F.concat(F.lit("clips/"), clip_id, F.lit(".mp4"))


def frame_uri(clip_id: Column) -> Column:
    return F.concat(F.lit("frames/"), clip_id, F.lit(".jpg"))


def padded_name(prefix: str, index: Column, width: int = 4) -> Column:
    """`prefix_0001`; numbers wider than `width` are kept whole."""
    text = index.cast("string")
    return F.concat(
        F.lit(f"{prefix}_"), F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
    )
