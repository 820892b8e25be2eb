"""Every query on empty tables, and on tables a third of which are equal rows with a null key."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from contractlake.llm import common, queries
from contractlake.llm.common import every_copy, in_chunks

from llm.plain_helpers import words

SF_DIR = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels".split()
# Names that operators use themselves, as further columns of every table.
CROWD = "key size row score kept shard slot text_ rank position deviation whitened ids tags anchor path_ n_words".split()


def folder_of(spark, frames, path):
    for name, frame in frames.items():
        frame.write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture(scope="module")
def given(spark):
    return {name: spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in TABLES}


@pytest.fixture(scope="module")
def empty(spark, given, tmp_path_factory):
    return folder_of(spark, {n: f.limit(0) for n, f in given.items()}, str(tmp_path_factory.mktemp("empty")))


@pytest.fixture(scope="module")
def hot(spark, given, tmp_path_factory):
    """As many rows again whose key and texts are null, or empty, all alike."""
    frames = {}
    for name, frame in given.items():
        n = frame.count() // 2
        null = [F.lit(None).cast(f.dataType).alias(f.name) for f in frame.schema]
        blank = [F.lit("").alias(c.name) if c.name in ("text", "html", "url") else null[i] for i, c in enumerate(frame.schema)]
        alike = spark.range(n, numPartitions=3).select(*null).unionByName(spark.range(n // 3).select(*blank))
        both = frame.unionByName(alike).repartition(4)
        frames[name] = both.withColumns({c: F.lit("x") for c in CROWD if c not in frame.columns})
    return folder_of(spark, frames, str(tmp_path_factory.mktemp("hot")))


@pytest.fixture()
def small_chunks(monkeypatch):
    monkeypatch.setattr(common, "COPIES", 16)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables_give_no_rows(spark, empty, name):
    found = queries.QUERIES[name](spark, empty)
    assert found.count() == 0
    assert {"doc_id", "vec_id", "page_id", "item_id"} & {*found.columns}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_empty_tables(spark, empty, name, stage):
    docs = spark.read.parquet(f"{empty}/documents.parquet")
    found = stage(spark, docs, empty)
    assert found.count() == 0
    if name != "pack":
        assert found.columns == docs.columns


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equal_rows_give_the_rows_of_the_sql(spark, given, hot, small_chunks, name):
    """The query reads the crowded tables, the SQL their own columns."""
    con = duckdb.connect()
    for table in TABLES:
        columns = ", ".join(given[table].columns)
        con.sql(f"CREATE VIEW {table} AS SELECT {columns} FROM '{hot}/{table}.parquet/*.parquet'")
    want = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, hot).select(*want.columns).collect()
    rows = want.fetchall()
    if name == "op2_embeddings":  # in SQL vectors without an id are one
        n = spark.read.parquet(f"{hot}/embeddings.parquet").where("vec_id IS NULL").count()
        assert [tuple(r) for r in got if r.vec_id is None] == [(None, 0, None, True)] * n
        got, rows = ([r for r in found if r[0] is not None] for found in (got, rows))
    assert Counter(map(str, map(tuple, got))) == Counter(map(str, rows))


def test_equal_rows_in_the_other_queries(spark, hot, small_chunks):
    """One result per row, equal for equal rows."""
    docs = spark.read.parquet(f"{hot}/documents.parquet").select("doc_id", "text").collect()
    ids = Counter(r.doc_id for r in docs)
    text = {r.doc_id: r.text for r in docs if r.doc_id is not None}
    for name in ("op3_quality", "op4_suffix_dedup", "op8_simhash", "op11_bpe"):
        rows = queries.QUERIES[name](spark, hot).collect()
        assert Counter(r.doc_id for r in rows) == ids, name
        if name != "op4_suffix_dedup":
            assert len({tuple(r) for r in rows if r.doc_id is None}) == 1, name
    packed = queries.op10_packing(spark, hot).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == ids
    places = {}
    for r in packed:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for slots in places.values():
        ends = np.cumsum([0, *(n for _, n in sorted(slots))])
        assert [o for o, _ in sorted(slots)] == ends[:-1].tolist() and ends[-1] <= 1024
    taken = {r.doc_id: r.taken for r in queries.op9_mixing(spark, hot).collect() if r.doc_id is not None}
    assert all(taken[k] <= 3 * len(words(t)) for k, t in text.items())
    pages = spark.read.parquet(f"{hot}/pages.parquet")
    judged = queries.op6_url_filter(spark, hot).collect()
    assert Counter(r.page_id for r in judged) == Counter(r.page_id for r in pages.select("page_id").collect())
    vectors = spark.read.parquet(f"{hot}/embeddings.parquet").where("embedding IS NOT NULL").count()
    assert queries.op12_whitening(spark, hot).count() == 32 * vectors


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_equal_rows(spark, hot, small_chunks, name, stage):
    docs = spark.read.parquet(f"{hot}/documents.parquet")
    found = stage(spark, docs, hot)
    if name != "pack":
        assert found.schema.simpleString() == docs.schema.simpleString()
    before, after = (Counter(r.doc_id for r in f.select("doc_id").collect()) for f in (docs, found))
    alone = {"simhash": 1, "mix": 3 * before[None], "pack": before[None]}.get(name, before[None])
    assert after[None] <= alone and {k for k in after if k is not None} <= {k for k in before}
    if name in ("suffix", "pack"):
        assert {*after} == {*before}
    if name == "mix":
        assert max(n for k, n in after.items() if k is not None) <= 3


def test_chunks_stand_for_every_copy(spark, small_chunks):
    counted = spark.createDataFrame([("a", 1), ("b", 16), ("c", 17), ("d", 1000)], "k string, n long")
    chunks = in_chunks(counted, "n")
    assert chunks.agg(F.max("n"), F.count("*")).first() == (16, 1 + 1 + 2 + 63)
    each = every_copy(chunks, ["k"], F.col("_part") * 16, "n", "i").groupBy("k").agg(F.count("*"), F.countDistinct("i"), F.max("i"))
    assert {tuple(r) for r in each.collect()} == {("a", 1, 1, 0), ("b", 16, 16, 15), ("c", 17, 17, 16), ("d", 1000, 1000, 999)}


def test_lines_that_end_with_carriage_returns(spark, given, tmp_path):
    text = "a line of words\r\n\r\n\r\nanother line\r\n\r\n" * 10
    docs = spark.createDataFrame([(1, text, "en", "s", 1), (2, "\r\n\r\n", "en", "s", 1)], given["documents"].schema)
    folder = folder_of(spark, {"documents": docs}, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = con.sql(queries.ORACLE["op1_host_rules"])
    got = queries.op1_host_rules(spark, folder).select(*want.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))
    assert {r.doc_id: r.n_dup_lines for r in got.collect()} == {1: 18, 2: 0}


def test_workers_need_not_have_the_package(tmp_path):
    """A driver that finds the package by sys.path only; workers start in another folder."""
    root = Path(__file__).resolve().parents[2]
    script = f"""
import sys
sys.path.insert(0, {str(root)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
from contractlake.llm import queries
for name in ("op10_packing", "op11_bpe", "op12_whitening", "op13_search"):
    print(name, queries.QUERIES[name](spark, {SF_DIR!r}).count())
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert len(done.stdout.split()) == 8
