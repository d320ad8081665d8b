"""URL verdicts: host and path rules first, else logistic regression on hashed character n-grams; expressions only.

The model reads the character 3- and 4-grams of host and path, hashed into ``BUCKETS`` weights; an url's features are
its bucket counts divided by their sum.  It is fitted on a small labelled table, made from general words and forms
(``labelled``), by full-batch gradient steps, each one an aggregation that brings back at most ``BUCKETS`` sums.  Scoring is one expression over the url.

Defined cases: a null url, or one without ``://``, has an empty host and path, no n-grams, and the verdict of the
model's intercept; rows are judged one by one, so repeated rows and ties need no rule; among fitting rules the longest
wins, the first by code point among equally long ones; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 1 << 13
STEPS, RATE, DECAY = 40, 6000.0, 2e-6
SIZES = (3, 4)

# The rules of the contract.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

# The small labelled table, made from words and forms: every form with every word, so that forms say nothing about the label.
BLOCKED = (
    "casino", "poker", "jackpot", "slots", "betting", "bet", "lottery", "porn", "xxx", "adult", "escort", "dating", "viagra", "pills", "pharma",
    "spam", "mailer", "ads", "adserver", "banner", "click", "tracker", "popup", "warez", "crack", "keygen", "torrent", "phishing", "malware", "loan",
    "replica", "cheap", "bonus", "free-prize", "win-cash", "sex", "cams", "gambling", "clickbait", "linkfarm",
    "adult-video", "nude", "adults-only", "track-user", "spyware", "spam-list", "free-money", "bets-online",
)
ALLOWED = (
    "wiki", "library", "school", "college", "museum", "journal", "science", "physics", "history", "news", "weather", "recipes", "kitchen", "garden", "travel",
    "health", "clinic", "code", "project", "manual", "docs", "books", "reading", "poems", "music", "theatre", "gallery", "maps", "city", "council",
    "parliament", "court", "archive", "papers", "lecture", "theory", "mathematics", "biology", "forest", "river", "ocean", "mountain", "railway", "bridge", "harbour",
    "village", "market", "farmers", "weekly", "tribune", "herald", "gazette", "notes", "essays", "stories", "children", "sports", "cycling", "walking", "chess",
    "clothing", "fishing", "washing", "something", "spring", "bathing", "weathering", "theory-of-things", "nothing", "teaching", "shoes", "shadow", "trade", "truck", "fresh",
    "insurance-office", "surgeon", "ontology", "northern", "eastward", "wayfarer", "laundry", "lantern", "hedgehog", "orchard", "bakery", "pottery", "weaving", "sailing", "astronomy",
)
FORMS = ("http://{a}-{b}.test/{n}", "https://www.{a}.test/en/{n}.html", "https://m.{a}{b}.test/{b}/{n}/", "http://blog.{b}.{a}.test/de/{n}")


def invented(count: int = 120) -> tuple[str, ...]:
    """Words of two to four syllables that mean nothing: an unknown name is no reason to block."""
    return tuple("".join("bdfghklmnprstvz"[(i * 7 + k * k * 5 + 3 * k) % 15] + "aeiou"[(i // 15 + i * k + k) % 5] + "nrsl"[(i + k) % 4] * ((i + k) % 2) for k in range(2 + i % 3)) for i in range(count))


def labelled(blocked=BLOCKED, allowed=(*ALLOWED, *invented()), forms=FORMS) -> tuple[tuple[str, int], ...]:
    """(url, 1: block) of every word in every form, with another word of its kind beside it."""
    out = []
    for words, label in ((blocked, 1), (allowed, 0)):
        for i, word in enumerate(words):
            out += [(form.format(a=word, b=words[(i + 7 * k + 1) % len(words)], n=37 * (i + 1) * (k + 3)), label) for k, form in enumerate(forms)]
    return tuple(out)


def host(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules=RULES) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits, else null."""
    chain = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), [-ord(c) for c in r[0] + r[1]])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        chain = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chain)
    return chain


def buckets(host: Column, path: Column) -> Column:
    """Bucket of every n-gram, in linear time: a look-ahead finds the overlapping grams."""
    text = F.concat(host, path)
    grams = [F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in SIZES]
    return F.transform(F.concat(*grams), lambda g: F.pmod(F.hash(g), F.lit(BUCKETS)))


def score(found: Column, weights: list[float], bias: float) -> Column:
    """Probability of "block" from the buckets of an url."""
    w = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded to one literal
    total = F.aggregate(found, F.lit(0.0), lambda acc, b: acc + F.get(w, b))
    return 1 / (1 + F.exp(-(bias + total / F.greatest(F.size(found), F.lit(1)))))


def fit(spark: SparkSession, table=None, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> tuple[list[float], float]:
    """Weights and intercept; the labelled table must be small (it is a parameter of the filter, not data)."""
    table = labelled() if table is None else table
    # One literal, a line for each row with the label first.
    lines = F.explode(F.split(F.lit("\n".join(f"{y}{u}" for u, y in table)), "\n"))
    rows = spark.range(0, 1, 1, 1).select(lines.alias("line")).select(F.expr("substring(line, 2)").alias("url"), F.expr("cast(substring(line, 1, 1) as double)").alias("y"))
    held = rows.select("y", buckets(host(F.col("url")), path(F.col("url"))).alias("found")).cache()
    weights, bias = [0.0] * BUCKETS, 0.0
    try:
        for _ in range(steps):
            gap = held.select("found", (score(F.col("found"), weights, bias) - F.col("y")).alias("gap"))
            each = gap.select(F.explode(F.concat("found", F.array(F.lit(-1)))).alias("b"), "gap", F.size("found").alias("n"))
            sums = each.groupBy("b").agg(F.sum(F.when(F.col("b") < 0, F.col("gap")).otherwise(F.col("gap") / F.col("n"))).alias("g")).collect()
            for b, g in sorted((r["b"], r["g"]) for r in sums):
                if b < 0:
                    bias -= 1.5 * g / len(table)
                else:
                    weights[b] -= rate * (g / len(table) + decay * weights[b])
    finally:
        held.unpersist()
    assert all(map(math.isfinite, weights))
    return weights, bias


def judge(pages: DataFrame, model: tuple[list[float], float], rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, p_block`` of every row of ``page_id, url``."""
    parts = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    found = parts.select(
        "*", matched_rule(F.col("host"), F.col("path"), rules).alias("m"), score(buckets(F.col("host"), F.col("path")), *model).alias("p_block")
    )
    by_model = F.when(F.col("p_block") >= 0.5, "block").otherwise("allow")
    return found.select("page_id", "host", "path", F.col("m.rule").alias("rule"), F.coalesce("m.verdict", by_model).alias("verdict"), "p_block")
