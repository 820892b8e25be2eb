from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from contractlake.llm.host_rules import HostRules, beta_prior, judge_documents, repeat_words, text_features

from llm.plain_helpers import words


def plain_repeat_words(found):
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    times = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)})


@given(st.lists(st.sampled_from("abc"), max_size=30))
@settings(max_examples=200, deadline=None)
def test_repeat_words(found):
    assert repeat_words(found) == plain_repeat_words(found)


def test_features():
    assert text_features(None) == (0, 0, 0, 0, 0, 0)
    assert text_features("a b\n\n \na b\nc#|") == (5, 7, 2, 3, 1, 0)


def test_prior_shrinks_small_hosts():
    alpha, beta = beta_prior(1000, 100, 20, 40.0)
    assert abs(alpha / (alpha + beta) - 0.1) < 0.01
    alone = (1 + alpha) / (1 + alpha + beta)
    large = (90 + alpha) / (100 + alpha + beta)
    assert alone < 0.5 < large
    assert sum(beta_prior(1000, 100, 20, 0.0)) == pytest.approx(1e6)


def test_bad_host_goes_and_clean_host_stays(spark):
    clean = " ".join(f"word{i}" for i in range(80))
    rows = [(i, clean, "good") for i in range(40)] + [(100 + i, "short", "bad") for i in range(40)]
    rows += [(200, clean, "bad"), (300, "short", "small"), (301, clean, None), (302, clean, "small")]
    got = {r.doc_id: r for r in judge_documents(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i].kept for i in range(40))
    assert got[200].kept is False and got[200].base_failed is False
    assert got[300].base_failed and not got[300].kept
    assert got[301].kept


def test_awkward(crowded, no_documents):
    got = judge_documents(crowded).collect()
    assert len(got) == crowded.count()
    texts = Counter((r.doc_id, len(words(r.text)), plain_repeat_words(words(r.text))) for r in crowded.collect())
    assert Counter((r.doc_id, r.n_words, r.n_repeat_words) for r in got) == texts
    assert all(isinstance(r.kept, bool) for r in got)
    assert judge_documents(no_documents).count() == 0


def test_hot_host_is_one_row(spark):
    frame = spark.range(3000).selectExpr(
        "id AS doc_id", "concat('a b c ', id) AS text", "if(id % 3 = 0, 'hot', concat('h', id % 50)) AS source"
    )
    got = judge_documents(frame, rules=HostRules(min_words=1)).agg({"host_documents": "max"}).first()[0]
    assert got == 1000
    assert np.isfinite(got)
