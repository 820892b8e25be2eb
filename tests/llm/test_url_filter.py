import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from contractlake.llm.queries import ALLOW_HOSTS, BLOCK_HOSTS, URL_RULES, labelled_urls
from contractlake.llm.url_filter import REGULARISATION, fit_urls, gram_buckets, host_of, judge_urls, path_of


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def plain_rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


URLS = [
    None, "", "no scheme/here", "http://", "http://A.Example.ORG", "http://a.example.org/es/1", "http://xexample.org/es/",
    "http://example.org/en/1?x#y", "http://example.org/en/2", "https://shop.com/fr/x", "https://shop.com/de/", "https://com/de/",
    "http://ÄB.com?q=/de/", "http://h.net#/fr/", "a://b://c/d", "http://free-casino.net/en/7", "http://library.net/en/7",
    "http://x.net/" + "a" * 20_000, "http://h.com/\nfr/", "http://h\n.org/x",
]


@pytest.fixture(scope="module")
def model(spark):
    return fit_urls(labelled_urls(spark))


def test_parts_rules_and_verdicts(spark, model):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, host string")
    got = {r.page_id: r for r in judge_urls(pages, "page_id", URL_RULES, model).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        host, path = plain_parts(url)
        rule = plain_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule and rule.name), url
        learned = "block" if got[i].score >= 0.5 else "allow"
        assert got[i].verdict == (rule.verdict if rule else learned)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_hosts_of_the_tables_are_not_in_the_labels(spark, model, sf):
    """The given pages are the held-out set: which of their hosts the model blocks by itself."""
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    host = host_of(F.col("url"))
    hosts = {r[0] for r in pages.select(F.regexp_extract(host, r"([^.]+)\.example\.[a-z]+$", 1)).distinct().collect()}
    assert not hosts & {*BLOCK_HOSTS, *ALLOW_HOSTS}
    spam = F.regexp_extract(host, r"([^.]+)\.example\.[a-z]+$", 1).rlike("-")
    rates = pages.groupBy(spam.alias("spam")).agg(F.avg((model.score(host, path_of(F.col("url"))) >= 0.5).cast("double")).alias("blocked"))
    rates = {r.spam: r.blocked for r in rates.collect()}
    assert rates[True] >= 0.85 and rates[False] <= 0.02


def test_score_is_the_plain_logistic_sum(spark, model):
    """The grams cut and summed one by one; their buckets from a table of single grams."""
    urls = [u for u in URLS if len(u or "") < 100]
    texts = ["^{}${}$".format(*plain_parts(u)) for u in urls]
    grams = [[t[i : i + 4] for i in range(max(len(t) - 3, 1))] for t in texts]
    known = spark.createDataFrame([(g,) for g in sorted({g for own in grams for g in own})], "gram string")
    bucket = {r.gram: r.b for r in known.select("gram", F.pmod(F.xxhash64("gram"), F.lit(2048)).alias("b")).collect()}
    frame = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: r.score for r in judge_urls(frame, "page_id", [], model).collect()}
    for i, own in enumerate(grams):
        margin = model.intercept + sum(model.weights[bucket[g]] for g in own)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-margin)), rel=1e-9)


def test_fit_is_the_least_of_the_penalised_loss(spark, model):
    """At the fitted weights the gradient of the plain loss is nearly nothing."""
    rows = [r.asDict() for r in labelled_urls(spark).select("block", gram_buckets(host_of(F.col("url")), path_of(F.col("url"))).alias("g")).collect()]
    x = np.zeros((len(rows), 2048))
    for i, r in enumerate(rows):
        np.add.at(x[i], r["g"], 1)
    y = np.array([r["block"] for r in rows])
    away = 1 / (1 + np.exp(-(x @ np.array(model.weights) + model.intercept))) - y
    gradient = x.T @ away / len(rows) + REGULARISATION * np.array(model.weights)
    assert np.abs(gradient).max() < 2e-3 and abs(away.mean()) < 2e-3


def test_model_tells_hosts_it_has_not_seen(spark, model):
    urls = [("http://www.royal-casino.example.net/en/5", 1), ("http://m.free-bets.example.net/de/8.html", 1),
            ("http://www.mountain-library.example.net/en/5", 0), ("http://theron.example.net/fr/12", 0)]
    frame = spark.createDataFrame(urls, "url string, block int")
    got = frame.select("block", model.score(host_of(F.col("url")), path_of(F.col("url"))).alias("s")).collect()
    assert all((r.s >= 0.5) == bool(r.block) for r in got)


def test_fit_needs_both_labels_and_a_small_table(spark):
    labelled = labelled_urls(spark)
    with pytest.raises(ValueError):
        fit_urls(labelled.where("block = 1"))
    with pytest.raises(ValueError):
        fit_urls(labelled, max_labelled=3)


def test_no_python_in_the_plan(spark, model):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = judge_urls(pages, "page_id", URL_RULES, model)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Exchange"))


def test_empty(spark, model):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(pages, "page_id", URL_RULES, model).count() == 0
