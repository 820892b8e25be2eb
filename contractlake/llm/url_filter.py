"""URL filter: rules by host suffix and path prefix, then logistic regression on hashed character
n-grams of host and path."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, functions as F

N_GRAM = 4
BUCKETS = 2048
REGULARISATION = 0.01
# Labelled rows the model is fitted on at most; more are an error, not a sample.
MAX_LABELLED = 10_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where there is no host part."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    start = F.instr(url, "://")
    whole = F.substring(url, start + 3, F.length(url))
    return F.coalesce(F.when(start > 0, whole), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, for paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        whole = F.concat(F.lit("."), host)
        return whole.endswith(f".{self.host}") & path.startswith(self.path)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as (``rule``, ``verdict``); null where none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        named = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(rule.fits(host, path), named).otherwise(found)
    return found


def gram_buckets(host: Column, path: Column, n: int = N_GRAM, buckets: int = BUCKETS) -> Column:
    """The bucket of each character n-gram of host and path, the two kept apart by a mark."""
    text = F.concat(F.lit("^"), host, F.lit("$"), path, F.lit("$"))
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - (n - 1), F.lit(1)))
    return F.transform(places, lambda i: F.pmod(F.xxhash64(F.substr(text, i, F.lit(n))), F.lit(buckets)))


@dataclass(frozen=True)
class UrlModel:
    """Weights by bucket: as many numbers as there are buckets, however large the tables."""

    weights: tuple[float, ...]
    intercept: float
    n: int

    def score(self, host: Column, path: Column) -> Column:
        """Probability of block, 0 to 1: the weights of the n-grams through the logistic curve."""
        weights = F.array(*[F.lit(w) for w in self.weights])
        grams = gram_buckets(host, path, self.n, len(self.weights))
        total = F.aggregate(grams, F.lit(0.0), lambda a, g: a + F.get(weights, g))
        return 1 / (1 + F.exp(-(total + self.intercept)))


def fit_urls(
    labelled: DataFrame,
    n: int = N_GRAM,
    buckets: int = BUCKETS,
    regularisation: float = REGULARISATION,
    max_labelled: int = MAX_LABELLED,
) -> UrlModel:
    """Fit on columns ``url`` and ``block`` (1 or 0); rows with a null in either are left out.

    A URL is the counts of its n-grams by bucket. Both labels must occur.
    """
    rows = labelled.where(F.col("url").isNotNull() & F.col("block").isNotNull())
    grams = gram_buckets(host_of(F.col("url")), path_of(F.col("url")), n, buckets)
    counts = CountVectorizerModel.from_vocabulary(
        [str(b) for b in range(buckets)], inputCol="grams", outputCol="features"
    )
    ready = counts.transform(
        rows.select(grams.cast("array<string>").alias("grams"), F.col("block").cast("double").alias("label"))
    ).drop("grams")
    seen = {row.label: row["count"] for row in ready.groupBy("label").count().collect()}
    if set(seen) != {0.0, 1.0} or sum(seen.values()) > max_labelled:
        raise ValueError(f"needs both labels and at most {max_labelled} rows, got {seen}")
    fitted = LogisticRegression(regParam=regularisation, standardization=False).fit(ready)
    return UrlModel(tuple(map(float, fitted.coefficients.toArray())), float(fitted.intercept), n)


def judge_urls(
    pages: DataFrame, key: str, rules: Sequence[Rule], model: UrlModel, threshold: float = 0.5
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict``, ``score`` for each row of ``pages``.

    The longest fitting rule decides, else the model: block from ``threshold`` on. Null URLs and
    those without ``://`` have an empty host and path, are met by no rule and scored as such.
    Rows stay one to one and nothing is shuffled; other columns of ``pages`` are not read.
    """
    parts = pages.select(
        F.col(f"`{key}`").alias(key), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    scored = parts.select(
        "*", rule_of(F.col("host"), F.col("path"), rules).alias("_rule"),
        model.score(F.col("host"), F.col("path")).alias("score"),
    )
    learned = F.when(F.col("score") >= threshold, "block").otherwise("allow")
    return scored.select(
        key, "host", "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", learned).alias("verdict"),
        "score",
    )
