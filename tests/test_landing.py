"""Incremental landing and file listings."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from contractlake.operators.flatten import column
from contractlake.operators.rejects import LoadError
from contractlake.plans.jobs import landing_manifest, run_year
from contractlake.sources.awards import award_files, award_records, discover_schema, parse_records
from contractlake.sources.files import file_manifest, landing_keys, size_class
from contractlake.streaming.landing import ingest_new_files, landed_files

from conftest import award_xml, plan_of, write_awards


def test_second_run_adds_only_the_new_file(spark, folder):
    src = f"{folder}/in"
    write_awards(f"{src}/a-AWARD.xml", [award_xml("1"), award_xml("2")])
    schema = discover_schema(award_records(spark, award_files(src)))

    def run(max_files=None):
        ingest_new_files(
            spark, award_files(src), f"{folder}/out", f"{folder}/state", schema, max_files=max_files
        )
        awards = spark.read.parquet(f"{folder}/out")
        piid = column("ns1:awardID.ns1:awardContractID.ns1:PIID")
        return sorted(r[0] for r in awards.select(piid).collect())

    assert run() == ["1", "2"]
    assert run() == ["1", "2"]
    write_awards(f"{src}/b-AWARD.xml", [award_xml("3")])
    write_awards(f"{src}/c-AWARD.xml", [award_xml("4")])
    write_awards(f"{src}/d-IDV.xml", [award_xml("5")])
    assert run(max_files=1) == ["1", "2", "3", "4"]


def test_late_file_of_old_time_and_odd_name_is_read(spark, folder):
    src = f"{folder}/in"
    write_awards(f"{src}/a-AWARD.xml", [award_xml("1")])
    schema = discover_schema(award_records(spark, award_files(src)))
    steps = [[("[x]{y}-AWARD.xml", "2", 1_000_000_000)], [("z-AWARD.xml", "3", None)]]
    seen = []
    for new in [[], *steps]:
        for name, piid, time in new:
            path = write_awards(f"{src}/{name}", [award_xml(piid)])
            if time:
                os.utime(path, (time, time))
        ingest_new_files(spark, award_files(src), f"{folder}/out", f"{folder}/state", schema)
        awards = spark.read.parquet(f"{folder}/out")
        piid = column("ns1:awardID.ns1:awardContractID.ns1:PIID")
        seen.append(sorted(r[0] for r in awards.select(piid).collect()))
    assert seen == [["1"], ["1", "2"], ["1", "2", "3"]]
    assert landed_files(spark, f"{folder}/state").count() == 3


def test_run_that_broke_off_is_cleared_up(spark, folder, monkeypatch):
    src = f"{folder}/in"
    write_awards(f"{src}/a-AWARD.xml", [award_xml("1")])
    schema = discover_schema(award_records(spark, award_files(src)))
    args = (spark, award_files(src), f"{folder}/out", f"{folder}/state", schema)
    with monkeypatch.context() as patch:
        patch.setattr(type(spark), "createDataFrame", lambda *_: 1 / 0)
        patch.setattr("contractlake.streaming.landing.landed_files", lambda s, _: s.sql("SELECT '' path, 0L length, now() modificationTime, 0L batch WHERE false"))
        with pytest.raises(ZeroDivisionError):
            ingest_new_files(*args)
    assert ingest_new_files(*args) == 1
    assert spark.read.parquet(f"{folder}/out").count() == 1


@pytest.mark.parametrize("ended", [True, False])
def test_landed_file_with_a_section_over_the_border_of_splits(spark, folder, ended):
    """Records in it are none; a section that does not end costs the rest of its file and stops the year."""
    src = f"{folder}/in"
    many = [award_xml(str(i)) for i in range(400)]
    write_awards(f"{src}/a-AWARD.xml", [award_xml("900"), "<!--", *many, "-->" if ended else "", award_xml("901")])
    write_awards(f"{src}/b-AWARD.xml", [award_xml("902")])
    schema = discover_schema(award_records(spark, f"{src}/b-AWARD.xml"))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        ingest_new_files(spark, award_files(src), f"{folder}/out", f"{folder}/state", schema)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    if not ended:
        with pytest.raises(LoadError, match="could not be read whole: .*a-AWARD.xml"):
            run_year(spark, f"{folder}/out", f"{folder}/lake", 2005, mode="landed")
    load = run_year(spark, f"{folder}/out", f"{folder}/lake", 2005, mode="landed", max_broken=not ended)
    assert sorted(r.PIID for r in spark.read.parquet(load.contract).collect()) == ["900", "901", "902"][:: 1 if ended else 2]
    rejects = spark.read.parquet(load.rejects).collect()
    assert [(list(r.reasons), r.source.endswith("a-AWARD.xml")) for r in rejects] == [(["incomplete file"], True)] * (not ended)


def test_landed_file_that_declares_another_encoding_stops_the_year(spark, folder):
    src = f"{folder}/in"
    write_awards(f"{src}/a-AWARD.xml", [award_xml("1")])
    schema = discover_schema(award_records(spark, award_files(src)))
    run = lambda: ingest_new_files(spark, award_files(src), f"{folder}/out", f"{folder}/state", schema)
    run()
    Path(f"{src}/b-AWARD.xml").write_text(f'<?xml version="1.0" encoding="ISO-8859-1"?>\n<r>{award_xml("2")}</r>')
    run()
    with pytest.raises(LoadError, match="could not be read whole: .*b-AWARD.xml"):
        run_year(spark, f"{folder}/out", f"{folder}/lake", 2005, mode="landed")


def test_batches_landed_without_the_file_columns_load_beside_later_ones(spark, folder):
    src, out = f"{folder}/in", f"{folder}/out"
    path = write_awards(f"{src}/a-AWARD.xml", [award_xml("1"), award_xml("2").replace("</ns1:vendorHeader>", "")])
    schema = discover_schema(award_records(spark, path))
    # numbered as a batch that an older version left
    parse_records(award_records(spark, path), schema).drop("file").write.parquet(f"{out}/batch=0")
    Path(f"{src}/b-AWARD.xml").write_text(f'<?xml version="1.0" encoding="ISO-8859-1"?>\n<r>{award_xml("3")}</r>')
    ingest_new_files(spark, f"{src}/b-AWARD.xml", f"{folder}/new", f"{folder}/state", schema)
    spark.read.parquet(f"{folder}/new/batch=0").write.parquet(f"{out}/batch=1")
    with pytest.raises(LoadError, match="b-AWARD.xml"):
        run_year(spark, out, f"{folder}/lake", 2005, mode="landed")
    load = run_year(spark, out, f"{folder}/lake", 2005, mode="landed", max_broken=1)
    found = sorted(r.reasons[0] for r in spark.read.parquet(load.rejects).collect())
    assert found == ["incomplete file", "malformed record"]
    assert [r.PIID for r in spark.read.parquet(load.contract).collect()] == ["1"]


def test_listing_opens_no_file(spark, folder):
    for name, size in (("x/a.xml", 10), ("y/a.xml", 11), ("y/z/b.xml", 12), ("c.txt", 1)):
        path = Path(folder, name)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"." * size)
    files = file_manifest(spark, folder)
    assert "content" not in plan_of(files).split("ReadSchema")[1]
    assert sorted(r.length for r in files.collect()) == [1, 10, 11, 12]
    assert file_manifest(spark, folder, "*.xml").count() == 3
    found = landing_manifest(spark, folder, "raw", max_size=10)
    assert sorted((r.landing_key, r.same_key, r.length, r.size_class) for r in found.collect()) == [
        ("raw/a.xml", 2, 10, "small"),
        ("raw/a.xml", 2, 11, "large"),
        ("raw/b.xml", 1, 12, "large"),
        ("raw/c.txt", 1, 1, "small"),
    ]


def test_collisions_of_a_very_common_name(spark):
    paths = spark.range(3000, numPartitions=4).select(
        F.concat(
            F.lit("d/"),
            F.col("id").cast("string"),
            F.when(F.col("id") % 3 > 0, "/index.html").otherwise(
                F.concat(F.lit("/"), F.col("id").cast("string"))
            ),
        ).alias("path")
    )
    counted = landing_keys(paths, "").groupBy("same_key").agg(
        F.count("*").alias("rows"), F.count_distinct("landing_key").alias("keys")
    )
    assert {tuple(r) for r in counted.collect()} == {(2000, 2000, 1), (1, 1000, 1000)}


def test_size_limit_is_strict(spark):
    sizes = spark.createDataFrame([(9,), (10,), (11,)], "n long").select(size_class(F.col("n"), 10))
    assert [r[0] for r in sizes.collect()] == ["small", "small", "large"]
