"""Source-URL columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipwarden.functions import paths

# --- Fixed values: canonical watch page and provider link formats ----------
WATCH_PREFIX = "https://www.youtube.com/watch?v="
SHORT_HOST = "youtu.be"
LONG_HOST = "youtube.com"
PATH_MARKERS = ["shorts", "embed", "v"]
PROVIDER_ID_PREFIX = "pexels_"
PROVIDER_PAGE = "https://www.pexels.com/video/"


def _blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def canonical_source_key(url: Column) -> Column:
    """One key per video, whatever form its link takes; other links are only trimmed."""
    text = F.trim(url)
    host = F.lower(F.coalesce(F.try_parse_url(text, F.lit("HOST")), F.lit("")))
    path = F.coalesce(F.try_parse_url(text, F.lit("PATH")), F.lit(""))
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    raw_v = F.try_parse_url(text, F.lit("QUERY"), F.lit("v"))
    from_query = _blank_to_null(F.coalesce(F.try_url_decode(raw_v), raw_v))
    from_path = F.when(F.get(parts, F.lit(0)).isin(PATH_MARKERS), _blank_to_null(F.get(parts, F.lit(1))))
    short = F.when(host == SHORT_HOST, F.nullif(F.trim(path, F.lit("/")), F.lit("")))
    is_long = (host == LONG_HOST) | host.endswith("." + LONG_HOST)
    found = F.coalesce(short, F.when(is_long, F.coalesce(from_query, from_path)))
    return F.coalesce(F.concat(F.lit(WATCH_PREFIX), found), text)


def timestamp_link(source: Column, seconds: Column) -> Column:
    return F.concat(
        F.lit(WATCH_PREFIX), source, F.lit("&t="), seconds.cast("bigint").cast("string"), F.lit("s")
    )


def provider_source_id(video_id: Column) -> Column:
    return F.concat(F.lit(PROVIDER_ID_PREFIX), video_id)


def provider_source_url(video_id: Column) -> Column:
    return F.concat(F.lit(PROVIDER_PAGE), video_id, F.lit("/"))


def extension_of(url: Column, default: str = ".mp4") -> Column:
    """Lower-case suffix of the URL's path, or `default`."""
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.regexp_replace(url, r"[?#].*$", ""))
    return F.coalesce(F.nullif(F.lower(paths.suffix(path)), F.lit("")), F.lit(default))
