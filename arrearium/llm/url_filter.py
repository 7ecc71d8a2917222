"""URL filter: rules first, then logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Fits host and all its subdomains where the url's path starts with path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rules_of(lines: Sequence[str]) -> list[Rule]:
    """Rules from lines such as 'block example.org/es/'."""
    out = []
    for line in lines:
        verdict, _, place = line.partition(" ")
        host, slash, path = place.partition("/")
        out.append(Rule(verdict, host, slash + path))
    return out


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty where the url is null or has no '://'."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def longest_rule(rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits host and path, else null; of equal length, the one listed first."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):  # later ones go before earlier ones
        host = F.col("host")
        fits = ((host == r.host) | host.endswith("." + r.host)) & F.col("path").startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(text: Column, tag: str, least: int, most: int) -> Column:
    """Character n-grams with a mark at both ends; the tag keeps those of host and path apart."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))

    def of(n: int) -> Column:
        starts = F.when(F.length(marked) >= n, F.sequence(F.lit(1), F.length(marked) - (n - 1))).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat(F.lit(tag), F.substring(marked, i, F.lit(n))))

    return F.concat(*[of(n) for n in range(least, most + 1)])


def features(urls: DataFrame, buckets: int = 1 << 16, least: int = 2, most: int = 4) -> DataFrame:
    """Add the sparse vector features from the columns host and path: n-grams that occur, hashed to buckets."""
    tf = HashingTF(inputCol="_grams", outputCol="features", numFeatures=buckets, binary=True)
    grams = F.concat(_grams(F.col("host"), "h", least, most), _grams(F.col("path"), "p", least, most))
    return tf.transform(urls.withColumn("_grams", grams)).drop("_grams")


def train(labelled: DataFrame, buckets: int = 1 << 16, penalty: float = 1e-3, rounds: int = 40) -> LogisticRegressionModel | str:
    """Fit on a small table of host, path, label (1.0: block). With one class only, the verdict for all."""
    classes = [r["label"] for r in labelled.select("label").distinct().limit(3).collect()]
    if len(classes) < 2:
        return "block" if classes == [1.0] else "allow"
    lr = LogisticRegression(maxIter=rounds, regParam=penalty, labelCol="label", standardization=False)
    return lr.fit(features(labelled, buckets).select("features", "label"))


def judge(pages: DataFrame, rules: Sequence[Rule], labelled: DataFrame | None = None, url_col: str = "url",
          most_labelled: int = 20_000, buckets: int = 1 << 16) -> DataFrame:
    """All columns of pages plus host, path, rule, verdict and score (the model's probability of block).

    labelled: a small table (url, label: 1 block, 0 allow). Without one, the rules label it: of the pages that a rule
    fits, at most about most_labelled distinct places, the first by hash. Where a rule fits, its verdict holds; else
    block if score >= 0.5. Null urls and urls without '://' have empty host and path and are scored like that.
    Repeated rows are judged each; columns of these names in pages are replaced, all others kept, whatever their names; an
    empty table stays empty. Very long urls are read whole.
    """
    host, path = host_and_path(url_col)
    names = ["host", "path", "rule", "verdict", "score"]
    kept = [c for c in pages.columns if c not in names]
    placed = pages.select(*[F.col(f"`{c}`").alias(f"c_{c}") for c in kept], host.alias("host"), path.alias("path"))
    placed = placed.withColumn("_rule", longest_rule(rules))
    if labelled is not None:
        host, path = host_and_path("url")
        small = labelled.select(host.alias("host"), path.alias("path"), F.col("label").cast("double").alias("label")).where("label is not null")
    else:
        small = placed.where("_rule is not null").select(
            "host", "path", (F.col("_rule.verdict") == "block").cast("double").alias("label")).distinct()
    small = small.orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(most_labelled)
    model = train(small, buckets)
    if isinstance(model, str):
        scored = placed.withColumn("score", F.lit(1.0 if model == "block" else 0.0))
    else:
        from pyspark.ml.functions import vector_to_array

        scored = model.transform(features(placed, buckets)).withColumn("score", vector_to_array("probability")[1])
    model_verdict = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(*[F.col(f"`c_{c}`").alias(c) for c in kept], "host", "path", F.col("_rule.rule").alias("rule"),
                         F.coalesce("_rule.verdict", model_verdict).alias("verdict"), "score")
