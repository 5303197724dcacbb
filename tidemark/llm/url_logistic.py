"""URL filter: host/path rules first, else logistic regression on hashed
character n-grams of host and path. DataFrame and SQL functions only.

Rules. A rule (host, path) fits its host and all subdomains when the url's
path starts with the rule's path; of the fitting rules the longest wins.

Model. 3- and 4-grams of host and path, each with its ends marked and its part
named, are hashed into a sparse vector; Spark's logistic regression learns
from a small labelled table (url, label 1 = block). ``LABELLED_ROWS`` bounds
that table.

Defined cases: a null url or one without ``://`` has empty host and path, no
rule and the method's verdict; an empty host or path gives only its marked
ends. With one class or no rows to learn from, the verdict is that class
(allow when there are none). Ties at probability 0.5 block.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_sample, stage

FEATURES = 1 << 13
LABELLED_ROWS = 4_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    text: str     # host and path, like net/es/

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (ASCII lower-cased) and path of a url; empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return (F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit("")))


def judge_by_rules(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """pages with host, path, rule and ruled (verdict or null), replacing
    columns of these names."""
    host, path = host_and_path(F.col(url))
    out = pages.withColumns({"host": host, "path": path})
    best = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fits = [((F.col("host") == r.host) | F.endswith(F.col("host"), F.lit("." + r.host)))
            & F.startswith(F.col("path"), F.lit(r.path)) for r in best]

    def first(values: list[str]) -> Column:
        hits = [F.when(f, F.lit(v)) for f, v in zip(fits, values, strict=True)]
        return F.coalesce(*hits, F.lit(None).cast("string"))

    return out.withColumns({"rule": first([r.text for r in best]), "ruled": first([r.verdict for r in best])})


def _grams(name: str, sizes: Sequence[int] = (3, 4)) -> Column:
    text = F.concat(F.lit("^"), F.col(name), F.lit("$"))
    parts = [F.transform(F.sequence(F.lit(0), F.greatest(F.length(text) - n, F.lit(0))),
                         lambda i, n=n: F.concat(F.lit(f"{name}:"), text.substr(i + 1, F.lit(n)))) for n in sizes]
    return reduce(F.concat, parts)


def featured(pages: DataFrame) -> DataFrame:
    """pages (with host and path) plus the hashed n-gram vector."""
    grams = pages.withColumn("_grams", F.array_distinct(F.concat(_grams("host"), _grams("path"))))
    return HashingTF(inputCol="_grams", outputCol="_features", numFeatures=FEATURES, binary=True).transform(grams)


def learn(labelled: DataFrame, bound: int = LABELLED_ROWS) -> LogisticRegressionModel | str:
    """Model from (url, label); the one class there is when it is one only."""
    host, path = host_and_path(F.col("url"))
    rows = bounded_sample(labelled.where("label is not null"), "url", bound)
    rows = stage(rows.select(F.col("label").cast("double").alias("label"), host.alias("host"), path.alias("path")),
                 "url-labels").orderBy("host", "path", "label")
    classes = sorted(r[0] for r in rows.groupBy("label").count().limit(2).collect())
    if len(classes) < 2:
        return "block" if classes == [1.0] else "allow"
    fit = LogisticRegression(featuresCol="_features", labelCol="label", maxIter=40, regParam=0.01)
    return fit.fit(featured(rows).coalesce(1))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], model: LogisticRegressionModel | str) -> DataFrame:
    """pages with host, path, rule, verdict and block_probability (null where
    the model is one class only)."""
    judged = judge_by_rules(pages, rules)
    if isinstance(model, str):
        out = judged.withColumn("block_probability", F.lit(None).cast("double"))
        other = F.lit(model)
    else:
        model = model.setProbabilityCol("_p").setRawPredictionCol("_raw").setPredictionCol("_prediction")
        out = model.transform(featured(judged)).withColumn("block_probability", vector_to_array("_p")[1])
        other = F.when(F.col("block_probability") >= 0.5, "block").otherwise("allow")
    return (out.withColumn("verdict", F.coalesce("ruled", other))
            .drop("_grams", "_features", "_raw", "_p", "_prediction", "ruled"))
