"""URL filter: allow and block rules first, then a logistic regression on hashed character n-grams.

Only DataFrame functions and JVM estimators run: hosts and paths are cut with string functions, n-grams of
host and path are arrays of substrings hashed by `HashingTF`, and the regression is trained on a small
labelled table, by default one made of the seed words below.

Defined results: a null url or one without `://` has an empty host and path, which no rule fits and the
regression judges like any other; a very long url is judged whole, in time proportional to its length; repeated rows give repeated results; an empty table gives an empty result.
Other columns are kept out of the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAMS = (3, 4, 5)
FEATURES = 1 << 14
BLOCK_AT = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Words of the hosts that the seed urls are made of.
BLOCKED_FIRST = ("casino", "cheap", "free", "spam", "ads", "adult", "bets", "click", "win", "viagra", "porn", "payday")
BLOCKED_LAST = ("win", "pills", "bets", "farm", "track", "x", "casino", "spins", "meds", "links", "loans", "cams")
ALLOWED_FIRST = (
    "th", "an", "er", "on", "re", "in", "ver", "tion", "gar", "lib", "mu", "sch", "his", "uni", "ma", "el", "vi", "cas",
)
ALLOWED_LAST = (
    "er", "the", "and", "ing", "den", "rary", "seum", "ule", "tory", "ble", "son", "ou", "es", "ly", "ha", "that", "or", "an",
)
SEED_HEADS = ("", "www.", "m.", "blog.")
SEED_ENDS = ("example.com", "example.net", "example.org")
SEED_PATHS = ("/en/12", "/fr/340/", "/de/7.html", "/es/88", "/en/901#top", "/page/3", "/en/64?page=2")


def seed_table(spark: SparkSession) -> DataFrame:
    """url, label (1: block) of the seed urls, some hundreds: every pair of a first and a last word is one host.

    Blocked words are joined by a hyphen or nothing, allowed ones mostly by nothing; heads, ends and paths are
    dealt round by round, so that none of them tells the classes apart.
    """
    blocked = [f"{a}{'' if i % 3 == 0 else '-'}{b}" for i, (a, b) in enumerate(product(BLOCKED_FIRST, BLOCKED_LAST))]
    allowed = [f"{a}{'-' if i % 20 == 0 else ''}{b}" for i, (a, b) in enumerate(product(ALLOWED_FIRST, ALLOWED_LAST))]
    rows = []
    for label, hosts in ((1.0, blocked), (0.0, allowed)):
        dealt = product(SEED_HEADS, SEED_ENDS, SEED_PATHS)
        every = list(dealt)
        for i, host in enumerate(hosts):
            head, end, path = every[i * 11 % len(every)]
            rows.append((f"https://{head}{host}.{end}{path}", label))
    return spark.createDataFrame(rows, "url string, label double")


def host_and_path(url: Column) -> tuple[Column, Column]:
    there = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    after = F.expr("substring(_url, locate('://', _url) + 3)")
    host = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.when(there, F.translate(host, UPPER, LOWER)).otherwise(empty), F.when(there, path).otherwise(empty)


def with_parts(df: DataFrame, url_col: str) -> DataFrame:
    """Adds `host` and `path`."""
    held = df.withColumn("_url", F.col(url_col).cast("string"))
    host, path = host_and_path(F.col("_url"))
    return held.withColumns({"host": host, "path": path}).drop("_url")


def with_grams(df: DataFrame) -> DataFrame:
    """Adds `grams`: all substrings of host and path of the lengths in `GRAMS`, ends marked.

    The text is cut into characters once and grams are put together from these, so a url takes time in
    proportion to its length, however long it is.
    """
    marked = F.concat(F.lit("^"), "host", "path", F.lit("$"))

    def per_size(chars: Column, n: int) -> Column:
        starts = F.sequence(F.lit(0), F.size(chars) - n)
        built = F.transform(starts, lambda i: F.concat(*[F.get(chars, i + k) for k in range(n)]))
        return F.when(F.size(chars) >= n, built).otherwise(F.array().cast("array<string>"))

    # bound by the outer lambda: a column could be inlined and cut anew for each gram
    made = F.transform(F.array(F.split(marked, "")), lambda chars: F.concat(*[per_size(chars, n) for n in GRAMS]))
    return df.withColumn("grams", F.get(made, F.lit(0)))


def hashing() -> HashingTF:
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True)


def train(labelled: DataFrame, url_col: str = "url", label_col: str = "label") -> LogisticRegressionModel:
    """Logistic regression on a small labelled url table."""
    rows = with_grams(with_parts(labelled.select(F.col(url_col).alias("url"), F.col(label_col).alias("label")), "url"))
    return LogisticRegression(maxIter=40, regParam=0.01).fit(hashing().transform(rows).select("features", "label").coalesce(1))


def fitting_rule(rules: Sequence[Rule]) -> Column:
    """Struct (text, verdict) of the longest rule that fits `host` and `path`, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict))
    choices = []
    for rule in ordered:
        host = F.lit(rule.host)
        fits = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + rule.host))
        choice = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        choices.append(F.when(fits & F.startswith(F.col("path"), F.lit(rule.path)), choice))
    none = F.lit(None).cast("struct<text:string,verdict:string>")
    return F.coalesce(*choices, none)


def judge(
    df: DataFrame, model: LogisticRegressionModel, rules: Sequence[Rule] = (), url_col: str = "url", id_col: str = "page_id"
) -> DataFrame:
    """id, host, path, rule, verdict, score (the regression's probability of block)."""
    narrow = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    parts = with_grams(with_parts(narrow, "url"))
    scored = model.setProbabilityCol("probability").transform(hashing().transform(parts))
    rule = fitting_rule(rules)
    score = vector_to_array("probability")[1]
    return scored.withColumns({"_rule": rule, "score": score}).select(
        F.col("page_id").alias(id_col), "host", "path", F.col("_rule.text").alias("rule"),
        F.coalesce("_rule.verdict", F.when(F.col("score") >= BLOCK_AT, "block").otherwise("allow")).alias("verdict"),
        "score",
    )
