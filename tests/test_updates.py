"""Years that follow a landed table: changed, emptied and restored files."""

import os
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from contractlake.operators.rejects import LoadError
from contractlake.plans import jobs
from contractlake.plans.jobs import LoadOptions, run_year, update_year
from contractlake.sinks.snapshots import expire_snapshots, latest_snapshot
from contractlake.sinks.tables import read_table
from contractlake.sources.awards import award_files, award_records, discover_schema
from contractlake.streaming.landing import ingest_new_files, landed_awards, landed_files

from conftest import award_xml, rows, write_awards


class Source:
    """A folder of award files, what lands from it and the lake that follows."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder
        self.landed, self.lake = f"{folder}/landed", f"{folder}/lake"
        sample = write_awards(f"{folder}/sample.xml", [award_xml("1"), award_xml("2", vehicle="V")])
        self.schema = discover_schema(award_records(spark, sample))
        self.clock = 1_700_000_000

    def write(self, name, *records, time=None):
        path = write_awards(f"{self.folder}/in/{name}-AWARD.xml", records)
        self.clock += 10
        os.utime(path, (time or self.clock,) * 2)
        return path

    def land(self):
        files = award_files(f"{self.folder}/in")
        return ingest_new_files(self.spark, files, self.landed, f"{self.folder}/state", self.schema)

    def update(self, **options):
        self.land()
        return update_year(self.spark, self.landed, self.lake, 2005, LoadOptions(**options))

    def table(self, name):
        return read_table(self.spark, self.lake, name)

    def piids(self):
        return sorted(r.PIID for r in self.table("contract").collect())

    def vendors(self):
        return {r.DUNSNumber: r.vendorName for r in self.table("vendor").collect()}


@pytest.fixture()
def source(spark, folder):
    return Source(spark, folder)


def test_changed_file_counts_once(source):
    source.write("a", award_xml("1"), award_xml("2"))
    source.write("b", award_xml("7", duns="000000007"))
    source.update()
    assert source.piids() == ["1", "2", "7"]
    source.write("a", award_xml("1"), award_xml("2"), award_xml("3"))
    source.update()
    assert source.piids() == ["1", "2", "3", "7"]
    assert source.vendors() == {"012345678": "V3", "000000007": "V7"}
    assert sorted(landed_awards(source.spark, source.landed).select("_batch").collect()) == [(0,), (1,), (1,), (1,)]
    # The same from a load of everything that has landed.
    load = run_year(source.spark, source.landed, f"{source.folder}/other", 2005, mode="landed")
    assert sorted(r.PIID for r in source.spark.read.parquet(load.contract).collect()) == ["1", "2", "3", "7"]


def test_awards_and_vendors_of_a_replaced_version_are_gone(source):
    source.write("a", award_xml("8", duns="000000001"), award_xml("2", duns="000000002"))
    source.write("b", award_xml("1", duns="000000001"), award_xml("5", duns="000000003"))
    source.update()
    assert source.vendors() == {"000000001": "V8", "000000002": "V2", "000000003": "V5"}
    source.write("a", award_xml("3", duns="000000004"))
    source.update()
    assert source.piids() == ["1", "3", "5"]
    assert source.vendors() == {"000000001": "V1", "000000004": "V3", "000000003": "V5"}
    source.write("b")  # no award is left in it
    source.update()
    assert source.piids() == ["3"] and source.vendors() == {"000000004": "V3"}


def test_file_restored_to_an_earlier_version_counts_again(source):
    source.write("a", award_xml("1"), time=1_600_000_000)
    source.update()
    source.write("a", award_xml("2"), award_xml("3"))
    source.update()
    source.write("a", award_xml("1"), time=1_600_000_000)
    source.update()
    assert source.piids() == ["1"] and source.vendors() == {"012345678": "V1"}


def test_nothing_new_does_nothing(source):
    source.write("a", award_xml("1"))
    assert source.update()
    version = latest_snapshot(source.spark, source.lake, 2005)
    assert source.update() is None
    assert latest_snapshot(source.spark, source.lake, 2005) == version


def test_rejects_follow_the_file_versions(source):
    bad = award_xml("2").replace("2.50<", "much<")
    source.write("a", award_xml("1"), bad, award_xml("4").replace("</ns1:vendorHeader>", ""))
    source.update()
    rejects = source.table("rejects").collect()
    assert sorted((r.reasons[0], r.table, r.source.endswith("a-AWARD.xml")) for r in rejects) == [
        ("malformed record", None, True), ("obligatedAmount is not decimal(18,2)", "contract", True),
    ]
    source.write("a", award_xml("1"), award_xml("2"))
    source.update()
    assert source.table("rejects").count() == 0 and source.piids() == ["1", "2"]


def test_only_new_batches_and_named_vendors_are_read(source):
    """What earlier runs landed and loaded cannot even be read during the second one."""
    source.write("a", *[award_xml(str(i), duns=f"{i:09}") for i in range(1, 9)])
    source.write("b", award_xml("100", duns="000000001"))
    first = source.update()
    source.write("b", award_xml("101", duns="000000002"))
    source.land()
    kept = {}
    for above in (f"{source.landed}/batch=0", first.contract):
        for file in Path(above).glob("*.parquet"):
            kept[file] = file.read_bytes()
            for name in (file, file.with_name(f".{file.name}.crc")):
                name.write_bytes(b"not to be read")
    with pytest.raises(Exception):
        landed_awards(source.spark, source.landed).count()
    second = update_year(source.spark, source.landed, source.lake, 2005)
    for file, content in kept.items():
        file.write_bytes(content)
        file.with_name(f".{file.name}.crc").unlink()
    assert source.spark.read.parquet(second.contract).count() == 1
    assert source.piids() == sorted([*map(str, range(1, 9)), "101"])
    assert source.vendors() == {f"{i:09}": f"V{i}" for i in range(1, 9)} | {"000000002": "V2"}


def test_updates_equal_a_load_of_everything(source):
    rng = random.Random(5)
    options = dict(widths={"vendorName": 4}, max_errors=10**6)

    def records():
        for _ in range(rng.randrange(0, 12)):
            award = award_xml(str(rng.randrange(10_000)), duns=rng.choice(["", *(f"00000000{i}" for i in range(8))]))
            yield award.replace(".50<", "?<") if rng.random() < 0.1 else award

    for _ in range(5):
        for name in rng.sample("abcdef", rng.randrange(1, 5)):
            source.write(name, *records())
        source.update(**options)
        run_year(source.spark, source.landed, f"{source.folder}/full", 2005, mode="landed", replace=True, **options)
        for table in ("contract", "vendor", "rejects"):
            assert rows(source.table(table)) == rows(read_table(source.spark, f"{source.folder}/full", table)), table
    # A load of everything is followed by updates like any other.
    source.write("a", award_xml("77777"))
    source.land()
    for lake in (source.lake, f"{source.folder}/full"):
        update_year(source.spark, source.landed, lake, 2005, LoadOptions(**options))
    for table in ("contract", "vendor", "rejects"):
        assert rows(source.table(table)) == rows(read_table(source.spark, f"{source.folder}/full", table)), table
    expire_snapshots(source.spark, source.lake, 2005, keep=1)
    assert rows(source.table("contract")) == rows(read_table(source.spark, f"{source.folder}/full", "contract"))


def test_update_that_fails_changes_nothing_and_can_be_run_again(source, monkeypatch):
    source.write("a", award_xml("1"), award_xml("2"))
    source.update()
    source.write("a", award_xml("3"))

    def fail(*_args, **_kwargs):
        raise OSError("disk")

    for step in ("_write_rejects", "_write_widths", "_follow_vendors", "publish"):
        with monkeypatch.context() as patch:
            patch.setattr(jobs, step, fail)
            with pytest.raises(OSError, match="disk"):
                source.update()
        assert source.piids() == ["1", "2"]
    source.update()
    assert source.piids() == ["3"]


def test_landing_that_broke_off_after_its_files_were_noted_is_completed(source, monkeypatch):
    source.write("a", award_xml("1"))
    with monkeypatch.context() as patch:
        patch.setattr("contractlake.streaming.landing._list_files", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            source.land()
    assert update_year(source.spark, source.landed, source.lake, 2005) is None
    source.write("b", award_xml("2"))
    source.update()
    assert source.piids() == ["1", "2"] and landed_files(source.spark, f"{source.folder}/state").count() == 2


def test_odd_file_names(source):
    for step in range(2):
        for name in ("a b", "ü%20", "x[1]{y}", "p+q=r#s"):
            source.write(name, award_xml(f"{step}{len(name)}"))
        source.update()
    assert source.piids() == sorted(f"1{n}" for n in (3, 4, 7, 7))


def test_years_that_do_not_follow_are_refused(source):
    source.write("a", award_xml("1"))
    run_year(source.spark, f"{source.folder}/in", source.lake, 2005)
    with pytest.raises(LoadError, match="does not follow"):
        source.update()


def test_lineage_shows_on_request(source):
    path = source.write("a", award_xml("1"))
    source.update()
    assert not {"_source", "_batch"} & {*source.table("contract").columns}
    (row,) = read_table(source.spark, source.lake, "contract", lineage=True).select("_source", "_batch").collect()
    assert row._source.endswith(path) and row._batch == 0


def test_default_width_cuts_no_file_name(source):
    source.write("a", award_xml("1"))
    source.update(default_width=4)
    source.write("a", award_xml("2"))
    source.update(default_width=4)
    assert source.piids() == ["2"]
    assert source.table("contract").where(F.length("unique_award_id") > 4).count() == 0
