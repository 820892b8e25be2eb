import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from contractlake.llm.qda import fit_quality, held_out, score_documents, statistics


@pytest.fixture(scope="module")
def model(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    return documents, labels, fit_quality(documents, labels.where(~held_out()))


def test_held_out_accuracy(model):
    documents, labels, fitted = model
    scored = score_documents(documents, fitted).join(labels, "doc_id").where(held_out())
    right, n = scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double")), F.count("*")).first()
    assert n > 50 and right >= 0.95


def test_scores_equal_the_plain_formula(model):
    documents, labels, fitted = model
    pdf = documents.select("doc_id", "text").toPandas().merge(labels.toPandas(), on="doc_id")
    pdf = pdf[[zlib.crc32(str(i).encode()) % 4 != 2 for i in pdf.doc_id]]
    x = np.array([statistics(t) for t in pdf.text])
    for c in (0, 1):
        assert np.allclose(x[pdf.quality.to_numpy() == c].mean(axis=0), fitted.means[c])
    densities = []
    for c in (0, 1):
        covariance = np.linalg.inv(fitted.inverse_factors[c].T @ fitted.inverse_factors[c])
        away = x - fitted.means[c]
        distance = np.einsum("ij,ij->i", away @ np.linalg.inv(covariance), away)
        densities.append(-0.5 * (distance + np.linalg.slogdet(covariance)[1]))
    margin = np.clip(densities[1] - densities[0] + fitted.log_prior, -500, 500)
    assert np.allclose(fitted.scores(x), 1 / (1 + np.exp(-margin)))


def test_labels_and_names_are_no_input(model, spark):
    _, _, fitted = model
    rows = [(1, "a text", "en", "x"), (2, "a text", "fr", "y")]
    got = score_documents(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), fitted)
    assert len({r.score for r in got.collect()}) == 1


def test_awkward(model, crowded, no_documents):
    _, _, fitted = model
    got = score_documents(crowded, fitted).collect()
    assert len(got) == crowded.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert score_documents(no_documents, fitted).count() == 0


def test_fit_with_awkward_labels(spark, awkward):
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (5, 0), (6, 0), (7, 1), (None, 1), (8, None), (99, 0), (3, 7)], "doc_id long, quality int"
    )
    fitted = fit_quality(awkward, labels)
    assert np.isfinite(fitted.log_dets).all()
    with pytest.raises(ValueError):
        fit_quality(awkward, labels.where("quality = 1"))


def test_null_key_is_not_held_out(spark):
    got = spark.createDataFrame([(None,), (3,)], "doc_id long").select(held_out().alias("h")).collect()
    assert [r.h for r in got] == [False, zlib.crc32(b"3") % 4 == 2]
