import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from contractlake.llm import queries
from contractlake.llm.common import staged
from contractlake.llm.curriculum import mix_sources, schedule_position, source_targets, training_order
from contractlake.llm.rendezvous import assign_shards, shard_slots


def records(frame):
    return frame.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc"),
    )


def test_slots_are_gapless_and_equal_rows_keep_their_number(spark, awkward, no_documents):
    got = shard_slots(records(awkward), "doc_id", 5).collect()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r.doc_id, r.size) for r in records(awkward).collect())
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 5)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by.values())
    by_key = {r.doc_id: r.crc for r in got}
    assert by_key[3] == zlib.crc32(b"")
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    assert shard_slots(records(no_documents), "doc_id", 5).count() == 0


def test_weights_and_growth(spark):
    frame = spark.range(40_000).withColumnRenamed("id", "k")
    grown = assign_shards(assign_shards(frame, "k", [1, 1, 2], "old"), "k", [1, 1, 2, 4], "new").collect()
    sizes = Counter(r.old for r in grown)
    assert abs(sizes[2] - 20_000) < 600 and abs(sizes[0] - 10_000) < 500
    moved = [r for r in grown if r.old != r.new]
    assert {r.new for r in moved} == {3} and abs(len(moved) - 20_000) < 600
    with pytest.raises(ValueError):
        assign_shards(frame, "k", [1, 0])


def test_no_python_on_the_way(spark, awkward):
    for frame in (shard_slots(records(awkward), "doc_id", 5), mix_sources(mix_input(awkward), (5, 2, 1))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Cartesian"))


def test_many_equal_keys(spark):
    frame = spark.range(9000).selectExpr("if(id % 3 = 0, 7L, id) AS doc_id")
    got = shard_slots(frame, "doc_id", 4).groupBy("shard").agg(F.count("*"), F.max("slot"), F.countDistinct("slot")).collect()
    assert all(r[1] == r[2] + 1 == r[3] for r in got)


def plain_targets(sizes, weights):
    """Share by weight again and again until no source is above three times its size."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, left = {}, Fraction(sum(sizes.values()))
    while True:
        free = [s for s in sizes if s not in full]
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 3 * sizes[s]]
        if not over:
            return full | {s: left * weight[s] / total for s in free}
        for s in over:
            full[s] = Fraction(3 * sizes[s])
        left = sum(sizes.values()) - sum(full.values())


@pytest.mark.parametrize(
    "sizes",
    [{"a": 5, "b": 900, "é": 40, None: 7}, {"x": 1, "y": 1, "z": 1000}, {"x": 0, "y": 0}, {"q": 12}],
)
def test_targets(spark, sizes):
    got = source_targets(spark.createDataFrame(list(sizes.items()), "source string, size long"), (5, 2, 1)).collect()
    want = plain_targets(sizes, (5, 2, 1))
    assert {r.source: pytest.approx(r.target) for r in got} == {s: float(t) for s, t in want.items()}


def mix_input(frame):
    return frame.select(
        F.col("doc_id").alias("key"), "source",
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
    )


def test_each_source_gives_its_target_to_the_word(awkward, no_documents):
    rows = mix_input(awkward)
    extra = rows.withColumn("target", F.lit("x")).withColumn("source_size", F.lit("y")).withColumn("_rows", F.lit(1))
    got = mix_sources(extra, (5, 2, 1)).collect()
    assert Counter((r.key, r.source, r.size) for r in got) == Counter((r.key, r.source, r.size) for r in rows.collect())
    given = defaultdict(int)
    for r in got:
        taken = sum(p.words for p in r.placements)
        given[r.source, r.target] += taken
        assert taken <= 3 * r.size
        assert all(0 <= p.position <= 1 and 0 < p.words <= r.size for p in r.placements)
        assert [p.position for p in r.placements] == sorted(p.position for p in r.placements)
    assert all(abs(words - target) <= 0.5 for (_, target), words in given.items())
    again = mix_sources(rows.repartition(7), (5, 2, 1)).collect()
    assert Counter(map(str, got)) == Counter(map(str, again))
    assert mix_sources(mix_input(no_documents), (5, 2, 1)).count() == 0


def test_schedule_is_the_inverse_of_its_integral(spark):
    for start, end in ((1.0, 3.0), (2.0, 2.0), (3.0, 1.0)):
        frame = spark.range(11).select((F.col("id") / 10).alias("t"))
        done = (start * F.col("t") + (end - start) * F.col("t") ** 2 / 2) / ((start + end) / 2)
        got = frame.select("t", schedule_position(done, F.lit(start), F.lit(end)).alias("back")).collect()
        assert all(abs(r.t - r.back) < 1e-12 for r in got)


def test_training_order_is_sorted_over_the_partitions(spark):
    frame = spark.range(500).selectExpr("id AS key", "if(id % 3 = 0, 'a', 'b') AS source", "1 + id % 9 AS size")
    ordered = training_order(mix_sources(frame, (5, 2)))
    places = [r.position for r in ordered.collect()]
    assert places == sorted(places) and len(places) >= 500
    # the first source starts slow and ends fast
    ranks = ordered.where("source = 'a'").agg(F.avg("position")).first()[0]
    assert ranks > 0.5


def test_query_writes_its_placements_in_training_order(spark, awkward, folder, monkeypatch):
    written = {}

    def kept(frame, purpose, made=None):
        written[purpose] = (frame, staged(frame, purpose, made))
        return written[purpose][1]

    awkward.select("doc_id", "text", "source").write.parquet(f"{folder}/documents.parquet")
    monkeypatch.setattr(queries, "staged", kept)
    got = queries.op9_mixing(spark, folder).collect()
    plan, order = written["order"][0]._jdf.queryExecution().executedPlan().toString(), written["order"][1].collect()
    assert "rangepartitioning(position" in plan and "Sort [position" in plan
    mixed = mix_sources(mix_input(awkward), (5, 2, 1)).collect()
    want = [p for r in mixed for p in r.placements]
    assert Counter((r.position, r.words) for r in order) == Counter((p.position, p.words) for p in want)
    assert Counter((r.doc_id, r.size, r.taken, r.first_position) for r in got) == Counter(
        (r.key, r.size, sum(p.words for p in r.placements), round(r.placements[0].position, 9) if r.placements else None)
        for r in mixed
    )
