"""The registered queries against their SQL, and the pipeline against a plain version."""

import os
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from contractlake.llm import queries
from contractlake.llm.packing import cut, token_ids
from contractlake.llm.qda import fit_quality, held_out, statistics
from contractlake.llm.settings import PATTERN, VOCABULARY

from llm.plain_helpers import Groups, words

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents embeddings pages labels benchmark".split()


def text_rows(df):
    names = sorted(df.columns)
    return sorted((tuple(str(r[n]) for n in names) for r in df.collect()))


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, oracle, name):
    ours = entry.queries()[name](spark, SF_DIR)
    theirs = oracle.sql(entry.oracle_sql()[name])
    order = sorted(theirs.columns)
    assert sorted(ours.columns) == order
    places = [theirs.columns.index(column) for column in order]
    assert text_rows(ours) == sorted(tuple(str(row[i]) for i in places) for row in theirs.fetchall())


def test_every_operator_is_registered():
    assert [n for i in range(1, 14) for n in entry.queries() if n.startswith(f"op{i}_")] and "pipeline" in entry.queries()
    assert sum(n.startswith("op") for n in entry.queries()) == 13


@pytest.fixture(scope="module")
def stages(spark):
    """Every stage's rows at the smallest scale, with its input."""
    from contractlake.llm.common import staged

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = found[name] = staged(stage(spark, docs, SF_DIR), name)
    return found


def plain(frame):
    return [r.asDict() for r in frame.collect()]


def test_quality_stage(spark, stages):
    docs = stages["documents"]
    model = fit_quality(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet").where(~held_out()))
    rows = plain(docs)
    scores = model.scores(np.array([statistics(r["text"]) for r in rows]))
    assert Counter(r["doc_id"] for r, s in zip(rows, scores) if s >= 0.7) == Counter(r["doc_id"] for r in plain(stages["quality"]))


def test_simhash_stage(stages):
    from llm.test_simhash import plain_fingerprint

    rows = plain(stages["quality"])
    prints = [plain_fingerprint(r["text"]) for r in rows]
    groups = Groups(range(len(rows)))
    for i, a in enumerate(prints):
        for j, b in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 3:
                groups.link(i, j)
    least = {}
    for i, r in enumerate(rows):
        least[groups.least(i)] = min(least.get(groups.least(i), r["doc_id"]), r["doc_id"])
    assert sorted(least.values()) == sorted(r["doc_id"] for r in plain(stages["simhash"]))


def test_suffix_stage(stages):
    rows = sorted(plain(stages["simhash"]), key=lambda r: r["doc_id"])
    seen, want = set(), {}
    for r in rows:
        data = r["text"].encode()
        cover = bytearray(len(data))
        new = []
        for p in range(len(data) - 199):
            if data[p : p + 200] in seen:
                cover[p : p + 200] = b"\1" * 200
            else:
                seen.add(data[p : p + 200])
        for i, b in enumerate(data):
            part = data[i] & 0xC0 == 0x80
            new.append((b, cover[i], part))
        # A character of which a byte stays, stays whole.
        kept, i = bytearray(), 0
        while i < len(data):
            end = i + 1
            while end < len(data) and data[end] & 0xC0 == 0x80:
                end += 1
            if not all(cover[i:end]):
                kept += data[i:end]
            i = end
        want[r["doc_id"]] = kept.decode()
    got = {r["doc_id"]: r["text"] for r in plain(stages["suffix"])}
    assert got == want
    assert all(r["n_chars"] == len(r["text"]) for r in plain(stages["suffix"]))


def test_mix_stage(stages):
    from llm.test_sharding_mixing import plain_targets

    before = {r["doc_id"]: r for r in plain(stages["suffix"])}
    sizes, given, times = defaultdict(int), defaultdict(int), Counter()
    for r in before.values():
        sizes[r["source"]] += len(words(r["text"]))
    for r in plain(stages["mix"]):
        whole = before[r["doc_id"]]
        n = len(words(r["text"]))
        assert words(whole["text"])[:n] == words(r["text"])
        given[r["source"]] += n
        times[r["doc_id"]] += 1
        assert r["n_chars"] == len(r["text"])
    targets = plain_targets(dict(sizes), (5, 2, 1))
    assert all(abs(given[s] - t) <= 0.5 for s, t in targets.items())
    assert max(times.values()) <= 3


def test_pack_stage(stages):
    want = Counter()
    for r in plain(stages["mix"]):
        for i, (start, length) in enumerate(cut(len(token_ids(r["text"], VOCABULARY, PATTERN)))):
            want[r["doc_id"], i, start, length] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in plain(stages["pack"])) == want


def test_stages_keep_columns_and_stand_awkward_rows(spark, crowded):
    docs = crowded
    for name, stage in corpus_pipeline.STAGES[1:]:  # these few documents have no labels to fit on
        found = stage(spark, docs, SF_DIR)
        rows = found.collect()
        assert rows, name
        if name != "pack":
            assert found.columns == docs.columns
            assert [f.dataType for f in found.schema] == [f.dataType for f in docs.schema]


def test_run(spark, stages):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert Counter(map(str, got.drop("sequence_id", "offset").collect())) == Counter(
        map(str, stages["pack"].drop("sequence_id", "offset").collect())
    )
    assert got.agg(F.countDistinct("sequence_id")).first()[0] == stages["pack"].agg(F.countDistinct("sequence_id")).first()[0]
