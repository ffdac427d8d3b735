"""URL filters: explicit rules first, boosted trees on lexical features for the rest (operator 9).

Host and path are cut out with SQL functions; the longest fitting rule decides. All other urls
get the verdict of gradient-boosted trees over length, depth, digit ratio, entropy, parameter
counts and suffix statistics. The labelled urls are those that a rule decides; the trees are
fitted on at most ``sample`` of their distinct feature rows, those of the smallest hashes. Suffix statistics
(number of urls and share of blocked ones, for the last host label and for the first path
segment) are counted over all urls.

Defined results: a null url, or one without ``://``, has empty host and path and no rule, and the
model judges it like any other; without labelled urls of both kinds the model says ``allow``;
repeated rows get equal verdicts; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import boosting
from quarry.llm.common import read_table

# The rules of the contract.
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block")]

#: Labelled rows used for fitting, at most.
SAMPLE = 20_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Feature name -> SQL over u (url), host, path, tail (from ? or # on) and the statistics.
FEATURES = {
    "url_length": "length(u)",
    "host_length": "length(host)",
    "path_length": "length(path)",
    "tail_length": "length(tail)",
    "host_labels": "length(host) - length(replace(host, '.', ''))",
    "host_hyphens": "length(host) - length(replace(host, '-', ''))",
    "host_digits": "length(host) - length(translate(host, '0123456789', ''))",
    "depth": "length(path) - length(replace(path, '/', ''))",
    "path_hyphens": "length(path) - length(replace(path, '-', ''))",
    "digit_ratio": "(length(u) - length(translate(u, '0123456789', ''))) / greatest(length(u), 1)",
    "letter_ratio": "(length(u) - length(translate(lower(u), 'abcdefghijklmnopqrstuvwxyz', ''))) / greatest(length(u), 1)",
    "entropy": "aggregate(array_distinct(split(u, '')), 0D, (a, c) -> a + if(c = '', 0D, -(length(u) - length(replace(u, c, '')))"
               " / length(u) * log2((length(u) - length(replace(u, c, ''))) / length(u))))",
    "parameters": "length(tail) - length(replace(tail, '=', ''))",
    "ampersands": "length(tail) - length(replace(tail, '&', ''))",
    "fragment": "if(instr(tail, '#') > 0, 1, 0)",
    "secure": "if(startswith(u, 'https'), 1, 0)",
    "suffix_n": "ln(1 + suffix_n)",
    "suffix_rate": "suffix_rate",
    "segment_n": "ln(1 + segment_n)",
    "segment_rate": "segment_rate",
}


def parse(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` as struct ``row`` with u, host, path and tail."""
    rows = pages.select(F.struct(*[pages[f"`{c}`"] for c in pages.columns]).alias("row"),
                        F.coalesce(pages[f"`{url}`"].cast("string"), F.lit("")).alias("u"))
    rows = rows.withColumn("rest", F.when(F.instr("u", "://") > 0, F.expr(
        "substring(u, instr(u, '://') + 3)")).otherwise(F.lit("")))
    return rows.select("row", "u", F.translate(F.regexp_extract("rest", "^([^/?#]*)", 1), UPPER, LOWER).alias("host"),
                       F.regexp_extract("rest", "^[^/?#]*([^?#]*)", 1).alias("path"),
                       F.regexp_extract("rest", r"^[^?#]*([?#][\s\S]*)", 1).alias("tail"))


def with_rule(rows: DataFrame, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    """Adds the longest fitting ``rule`` and its verdict ``ruled`` (null without one)."""
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, verdict in sorted(rules, key=lambda r: len(r[0])):        # the longest is tested first
        host, path = text.split("/", 1)
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit("/" + path))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        ruled = F.when(fits, F.lit(verdict)).otherwise(ruled)
    return rows.withColumn("rule", rule).withColumn("ruled", ruled)


def with_statistics(rows: DataFrame) -> DataFrame:
    """Adds, for the last host label (suffix) and the first path segment, the number of urls with it
    and the smoothed share of blocked ones among those that a rule decides."""
    parts = {"suffix": F.substring_index("host", ".", -1), "segment": F.substring_index(F.substring("path", 2, 1 << 30), "/", 1)}
    for name, value in parts.items():
        rows = rows.withColumn(name, value)
        totals = rows.groupBy(F.col(name).alias("s")).agg(
            F.count("*").alias(f"{name}_n"),
            ((F.count_if(F.col("ruled") == "block") + 1) / (F.count("ruled") + 2)).alias(f"{name}_rate"))
        rows = rows.join(totals, F.col(name) == F.col("s"), "left").drop("s", name)
    return rows


def fit_verdicts(rows: DataFrame, sample: int = SAMPLE) -> boosting.Boosted:
    """Trees for "block", fitted on at most ``sample`` labelled rows that have the features."""
    labelled = rows.where("ruled is not null").select(
        (F.col("ruled") == "block").cast("double").alias("y"), *[F.col(f).cast("double").alias(f) for f in FEATURES]).distinct()
    labelled = labelled.withColumn("_order", F.xxhash64(*labelled.columns))
    found = boosting.bounded_sample(labelled, sample)
    return boosting.fit(found[:, 1:], found[:, 0])


def judge(pages: DataFrame, url: str = "url", rules: list[tuple[str, str]] = RULES, sample: int = SAMPLE) -> DataFrame:
    """``pages`` as struct ``row`` with host, path, rule, verdict and the model's log-odds ``score``."""
    rows = with_statistics(with_rule(parse(pages, url), rules))
    features = F.struct(*[F.expr(v).cast("double").alias(k) for k, v in FEATURES.items()])
    rows = rows.select("row", "u", "host", "path", "rule", "ruled", features.alias("f"))
    model = fit_verdicts(rows.select("u", "ruled", *[F.col(f"f.{k}").alias(k) for k in FEATURES]), sample)
    score = F.expr(model.sql([f"f.{k}" for k in FEATURES]))
    return rows.withColumn("score", score).withColumn(
        "verdict", F.coalesce("ruled", F.when(F.col("score") > 0, "block").otherwise("allow"))) \
        .select("row", "host", "path", "rule", "verdict", "score")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of ``pages``: host, path, rule and verdict."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")
