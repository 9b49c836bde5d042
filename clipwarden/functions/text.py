"""Prompt, caption, label and timestamp text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipwarden.functions.numbers import round_even

# every character Python counts as white space, as a regex class and as a plain list
WS = r"(?U)[\s\x1c-\x1f]"
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(value: Column) -> Column:
    """Trim white space of any kind on both ends."""
    return F.btrim(value, F.lit(WS_CHARS))


def word_count(value: Column) -> Column:
    """Number of white-space separated words; 0 for null or blank text."""
    text = strip(value)
    return F.when(F.coalesce(text, F.lit("")) == "", 0).otherwise(F.size(F.split(text, rf"{WS}+")))


def char_count(value: Column) -> Column:
    return F.coalesce(F.length(value), F.lit(0))


def caption_length(value: Column, null_as: str = "None") -> Column:
    """Length of the caption's text form; a missing caption counts as the text `null_as`."""
    return F.length(F.coalesce(value, F.lit(null_as)))


def at_most(value: Column, limit: int | None) -> Column:
    """The first `limit` characters if a limit is given, else the whole text."""
    return value if limit is None else F.substring(value, 1, limit)


def caption_or(new: Column, old: Column, limit: int | None = None) -> Column:
    """Trimmed new caption, whole unless `limit` is given; the old prompt where that is empty."""
    return F.coalesce(F.nullif(at_most(strip(new), limit), F.lit("")), old)


def prompt_or_default(prompt: Column, sample_id: Column) -> Column:
    return F.coalesce(
        F.nullif(strip(prompt), F.lit("")), F.concat(F.lit("Video sample "), sample_id, F.lit("."))
    )


def clock_text(seconds: Column) -> Column:
    """Whole seconds as `M:SS`, or `H:MM:SS` from one hour on."""
    s = seconds.cast("bigint")
    h, m, sec = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    short = F.concat(m.cast("string"), F.lit(":"), two(sec))
    return F.when(h > 0, F.concat(h.cast("string"), F.lit(":"), two(m), F.lit(":"), two(sec))).otherwise(
        short
    )


def cue_text(seconds: Column) -> Column:
    """Seconds rounded half to even as `S`, `M:SS` or `H:MM:SS`."""
    s = round_even(seconds.cast("double"))
    return F.when(s < 60, s.cast("string")).otherwise(clock_text(s))


def resolution_label(height: Column) -> Column:
    return (
        F.when(height >= 2160, "4k")
        .when(height >= 1440, "2k")
        .when(height >= 1080, "1080p")
        .when(height >= 720, "720p")
        .otherwise(F.concat(height.cast("bigint").cast("string"), F.lit("p")))
    )


def build_prompt(template: str, query: Column, height: Column) -> Column:
    """Fill `{description}`, `{query}`, `{resolution}` and `{height}` of a prompt template."""
    words = strip(F.regexp_replace(query, rf"{WS}+", " "))
    values = {
        "{description}": words,
        "{query}": words,
        "{resolution}": resolution_label(height),
        "{height}": height.cast("bigint").cast("string"),
    }
    pieces, rest = [], template
    while rest:
        hits = [(rest.find(k), k) for k in values if k in rest]
        at, key = min(hits) if hits else (len(rest), "")
        if at:
            pieces.append(F.lit(rest[:at]))
        if key:
            pieces.append(values[key])
        rest = rest[at + len(key):]
    return F.concat(*pieces) if pieces else F.lit("")


def primary_category(reason: Column) -> Column:
    """Text before the first `=`, then before the first `;`."""
    return F.trim(F.split_part(F.split_part(reason, F.lit("="), F.lit(1)), F.lit(";"), F.lit(1)))


# --- Fixed values: issue category per word found in a fail reason ----------
ISSUE_WORDS = {
    "duplicate": "DUPLICATE",
    "static": "STATIC",
    "timelapse": "TIMELAPSE",
    "scene_cuts": "SCENE_CUT",
    "clipping": "CLIPPING",
    "conformance": "LOW_CONFORMANCE",
}


def issue_categories(reason: Column, grade: Column) -> Column:
    """Categories of a failed row as an array; empty for other grades."""
    low = F.lower(reason)
    hits = F.array_compact(F.array(*[F.when(low.contains(w), F.lit(c)) for w, c in ISSUE_WORDS.items()]))
    named = F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit("OTHER")))
    return F.when(grade == "FAIL", named).otherwise(F.array().cast("array<string>"))
