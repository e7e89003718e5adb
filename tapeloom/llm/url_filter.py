"""URL verdicts: a rule list first, then logistic regression on hashed character n-grams of host and path.

The model is fitted by the DataFrame-based ML library on a small labelled table of URLs, which also gives its
threshold and, in a part that it never sees, its precision and recall. Everything
on the way from a URL to its verdict is built-in expressions and JVM code.
"""

from __future__ import annotations

import csv
from dataclasses import dataclass, replace
from pathlib import Path

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm.common import ascii_lower

#: Fixed values: (host, start of the path, verdict).
RULES: tuple[tuple[str, str, str], ...] = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: A small labelled table of invented URLs: url, label (block or allow) and part (train, validation or test, by host).
LABELLED = Path(__file__).with_name("labelled_urls.csv")


@dataclass(frozen=True)
class Settings:
    """Hash buckets, n-gram lengths and regularisation."""

    buckets: int = 1 << 16
    shortest: int = 3
    longest: int = 5
    regularisation: float = 0.001


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first :// up to /, ?, # or the end, A-Z lower-cased; path from there up to ? or #; both empty without ://."""
    there = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(there > 0, F.substring(url, there + 3, F.length(url))).otherwise(F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null; of equally long ones a blocking one first, then by text.

    A rule fits its host and all subdomains, where the path starts with the rule's. rules is a short list: each is one condition.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[2] == "block", r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def grams(host: Column, path: Column, s: Settings) -> Column:
    """Character n-grams of host and path, marked by where they come from."""
    out = []
    for mark, text in (("h", F.concat(F.lit("^"), host, F.lit("$"))), ("p", F.concat(F.lit("^"), path, F.lit("$")))):
        for n in range(s.shortest, s.longest + 1):
            out.append(F.when(F.length(text) >= n, _marked(mark, text, n)).otherwise(F.array().cast("array<string>")))
    return F.concat(*out)


def _marked(mark: str, text: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.concat(F.lit(mark), F.substring(text, i, n)))


def labelled_urls(spark: SparkSession, path: Path | str = LABELLED) -> DataFrame:
    """host, path, label (1: block) and part of a labelled table on the driver, a CSV file with the columns url, label and part."""
    with open(path, newline="") as f:
        rows = [(r["url"], float(r["label"] == "block"), r["part"]) for r in csv.DictReader(f)]
    host, rest = parts(F.col("url"))
    return spark.createDataFrame(rows, "url string, label double, part string").coalesce(1).select(host.alias("host"), rest.alias("path"), "label", "part")  # small: one task a step


def _vectors(df: DataFrame, s: Settings) -> DataFrame:
    return HashingTF(numFeatures=s.buckets, binary=True, inputCol="grams", outputCol="features").transform(df.withColumn("grams", grams(F.col("host"), F.col("path"), s))).drop("grams")


@dataclass(frozen=True)
class UrlModel:
    """Logistic regression, and the chance from which it blocks."""

    regression: LogisticRegressionModel
    threshold: float
    settings: Settings

    def scored(self, df: DataFrame) -> DataFrame:
        """df (host, path, ...) with score, the chance of block."""
        return self.regression.transform(_vectors(df, self.settings)).withColumn("score", vector_to_array("chance")[1]).drop("features", "raw", "chance", "guess")


def fit(labelled: DataFrame, s: Settings = Settings()) -> UrlModel:
    """Learn from the train part of a labelled table (host, path, label, part); the validation part gives the threshold.

    The threshold is the one of the scores there with the best F1, and of equally good ones the middle between
    the first and the next lower score; without validation rows it is a half. The table is small, so its scores may be
    collected.
    """
    learner = LogisticRegression(regParam=s.regularisation, maxIter=60, standardization=False, featuresCol="features", labelCol="label", probabilityCol="chance", rawPredictionCol="raw", predictionCol="guess")
    model = UrlModel(learner.fit(_vectors(labelled.filter("part = 'train'"), s)), 0.5, s)
    scores = sorted(((r.score, r.label) for r in model.scored(labelled.filter("part = 'validation'")).select("score", "label").collect()), reverse=True)
    n_block, hits, best = sum(label == 1 for _, label in scores), 0, (0.0, 0.5)
    for i, (score, label) in enumerate(scores):
        hits += label == 1
        below = scores[i + 1][0] if i + 1 < len(scores) else 0.0
        if below < score and n_block:
            best = max(best, (2 * hits / (i + 1 + n_block), (score + below) / 2))
    return replace(model, threshold=best[1])


def judged(pages: DataFrame, model: UrlModel, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score (chance of block by the model) of every row of pages.

    pages needs page_id and url; other columns are not read. Defined results: a null url, or one without ://,
    has empty host and path, fits no rule and is judged by the model; a null page_id and repeated rows are
    returned as they are; an empty table gives none; a url of any length gives all its n-grams; of equally long rules
    that fit, one that blocks goes first.
    """
    host, path = parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    scored = model.scored(rows).withColumn("found", fitting_rule(F.col("host"), F.col("path"), rules))
    guess = F.when(F.col("score") >= model.threshold, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", guess).alias("verdict"), "score")
