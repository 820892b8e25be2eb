"""The year job from XML folder to tables."""

import zipfile
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from contractlake.functions.keys import DUNS
from contractlake.operators.rejects import LoadError
from contractlake import session
from contractlake.plans import jobs
from contractlake.plans.jobs import run_year, run_years
from contractlake.sinks import snapshots
from contractlake.sinks.tables import read_table, write_contract
from contractlake.sources.awards import award_records, discover_schema

from conftest import award_xml, write_awards


def src_with(folder, *records, name="A-AWARD.xml"):
    write_awards(f"{folder}/in/{name}", records)
    return f"{folder}/in"


def broken_amount(piid):
    return award_xml(piid).replace(f"{piid}.50<", "much<")


def test_year_load(spark, folder):
    src = src_with(
        folder,
        award_xml("1", duns="000000009", vehicle="IDV", extra=f"<ns1:text>{'é' * 200}</ns1:text>"),
        award_xml("2", duns="000000009"),
        award_xml("3", duns=""),
        broken_amount("4"),
        award_xml("5").replace("</ns1:vendorHeader>", ""),
    )
    write_awards(f"{src}/B-IDV.xml", [award_xml("6")])
    paths = run_year(spark, src, f"{folder}/out", 2005, widths={"text": 21})
    contract = {r.PIID: r for r in spark.read.parquet(paths.contract).collect()}
    assert set(contract) == {"1", "2", "3"}
    assert contract["1"].referencedID == "IDV_9700_0" and contract["2"].referencedID is None
    assert contract["1"].text == "é" * 10
    assert contract["3"].DUNSNumber is None
    schema = spark.read.parquet(paths.contract).schema
    assert schema["obligatedAmount"].dataType.simpleString() == "decimal(18,2)"
    assert schema["signedDate"].dataType.simpleString() == "timestamp_ntz"
    assert (schema["text"].metadata["maxlength"], schema["PIID"].metadata.get("maxlength")) == (21, None)
    assert paths.cuts["contract"] == {"text": 1} and paths.cuts["vendor"] == {}
    assert schema["DUNSNumber"].metadata["path"] == DUNS
    assert spark.read.parquet(paths.vendor).schema["DUNSNumber"].metadata["path"] == DUNS
    vendors = spark.read.parquet(paths.vendor).collect()
    assert {r.DUNSNumber: r.vendorName for r in vendors} == {"000000009": "V2", "012345678": "V4"}
    rejects = spark.read.parquet(paths.rejects).collect()
    assert {(r.PIID, tuple(r.reasons)) for r in rejects} == {
        ("4", ("obligatedAmount is not decimal(18,2)",)),
        (None, ("malformed record",)),
    }
    assert [r.record for r in rejects if r.record][0].startswith("<ns1:award version")


def test_file_mode_and_renames(spark, folder):
    rename = {DUNS: "duns", "ns1:relevantContractDates.ns1:signedDate": "action_date"}
    paths = run_year(
        spark,
        src_with(folder, award_xml("1"), award_xml("2")),
        f"{folder}/out",
        2005,
        rename=rename,
        types={"action_date": "date"},
        mode="files",
        date="action_date",
        layout="ranged",
    )
    contract = spark.read.parquet(paths.contract)
    assert {"duns", "action_date"} < set(contract.columns)
    assert dict(contract.dtypes)["action_date"] == "date"
    assert spark.read.parquet(paths.vendor).columns == ["vendorName", "duns"]
    assert spark.read.parquet(paths.rejects).count() == 0


def test_year_from_archives(spark, folder):
    Path(folder, "in").mkdir()
    for name, members in {
        "a.zip": {"x/A-AWARD.xml": award_xml("1") + award_xml("2"), "B-IDV.xml": award_xml("9")},
        "[b].zip": {"[A]-AWARD.xml": "<r>" + award_xml("3") + "</r>"},
    }.items():
        with zipfile.ZipFile(Path(folder, "in", name), "w") as archive:
            for member, text in members.items():
                archive.writestr(member, text)
    Path(folder, "in", "broken.zip").write_bytes(b"PK")
    with pytest.raises(LoadError, match="could not be read whole.*broken.zip"):
        run_year(spark, f"{folder}/in", f"{folder}/out", 2005, mode="archives")
    paths = run_year(spark, f"{folder}/in", f"{folder}/out", 2005, mode="archives", max_broken=1)
    assert {r.PIID for r in spark.read.parquet(paths.contract).collect()} == {"1", "2", "3"}
    (reject,) = spark.read.parquet(paths.rejects).collect()
    assert "broken.zip: " in reject.record and list(reject.reasons) == ["incomplete file"]


def test_other_members_of_a_broken_archive_load(spark, folder):
    Path(folder, "in").mkdir()
    for n in range(3):
        with zipfile.ZipFile(Path(folder, "in", f"{n}.zip"), "w") as archive:
            archive.writestr("A-AWARD.xml", "<r>" + "".join(award_xml(str(1000 * n + i)) for i in range(200)) + "</r>")
            if n:
                archive.writestr("B-AWARD.xml", b"<ns1:award>\xff\xfe</ns1:award>")
    paths = run_year(spark, f"{folder}/in", f"{folder}/out", 2005, mode="archives", max_broken=2)
    assert spark.read.parquet(paths.contract).count() == 600
    assert spark.read.parquet(paths.rejects).count() == 2


def test_nothing_is_cut_unless_asked(spark, folder):
    text = "x" * 5000
    paths = run_year(spark, src_with(folder, award_xml("1", extra=f"<ns1:text>{text}</ns1:text>")), f"{folder}/out", 2005)
    assert spark.read.parquet(paths.contract).first().text == text
    assert paths.cuts == {"contract": {}, "vendor": {}}


def test_incomplete_file_stops_a_load_in_file_mode(spark, folder):
    bad = award_xml("2").replace("</ns1:vendorHeader>", "")
    src = src_with(folder, award_xml("1"), bad, *[award_xml(str(i)) for i in range(3, 40)])
    with pytest.raises(LoadError, match="A-AWARD.xml"):
        run_year(spark, src, f"{folder}/out", 2005, mode="files")
    paths = run_year(spark, src, f"{folder}/out", 2005)
    assert spark.read.parquet(paths.contract).count() == 38
    (reject,) = spark.read.parquet(paths.rejects).collect()
    assert reject.source.endswith("A-AWARD.xml") and "<ns1:PIID>2<" in reject.record


def test_vendor_rules_and_types(spark, folder):
    staff = [award_xml(str(i), duns=f"00000000{i}").replace("</ns1:vendorHeader>", f"</ns1:vendorHeader><ns1:staff>{n}</ns1:staff>") for i, n in ((1, "5"), (2, "many"), (3, "7"))]
    rules = {"too many": F.col("staff").try_cast("int") > 6}
    paths = run_year(spark, src_with(folder, *staff), f"{folder}/out", 2005, types={"staff": "int"}, vendor_rules=rules)
    assert [(r.DUNSNumber, r.staff) for r in spark.read.parquet(paths.vendor).collect()] == [("000000001", 5)]
    rejects = {(r.table, tuple(r.reasons)) for r in spark.read.parquet(paths.rejects).collect()}
    assert rejects == {("vendor", ("staff is not int",)), ("vendor", ("too many",))}
    assert spark.read.parquet(paths.contract).count() == 3


def test_own_rules(spark, folder):
    src = src_with(folder, award_xml("1"), award_xml("2"))
    rules = {"amount too small": F.col("obligatedAmount").try_cast("double") < 2}
    paths = run_year(spark, src, f"{folder}/out", 2005, rules=rules)
    assert [r.reasons for r in spark.read.parquet(paths.rejects).collect()] == [["amount too small"]]


def test_49_rejects_load_and_50_raise(spark, folder):
    src = src_with(folder, award_xml("1"), *[broken_amount(str(i)) for i in range(2, 51)])
    out = f"{folder}/out"
    paths = run_year(spark, src, out, 2005)
    assert spark.read.parquet(paths.rejects).count() == 49
    write_awards(f"{src}/B-AWARD.xml", [broken_amount("51")])
    with pytest.raises(LoadError, match="50 rows"):
        run_year(spark, src, out, 2006)
    assert not Path(out, "contract", "year=2006").exists()
    assert not Path(out, "rejects", "year=2006").exists()


def test_loaded_year_is_not_loaded_again(spark, folder):
    src = src_with(folder, award_xml("1"))
    run_year(spark, src, f"{folder}/out", 2005)
    with pytest.raises(LoadError, match="exists"):
        run_year(spark, src, f"{folder}/out", 2005)


def years_of(spark, folder, table):
    return {r.year for r in read_table(spark, f"{folder}/out", table).select("year").collect()}


def contract_piids(spark, folder):
    return sorted(r.PIID for r in read_table(spark, f"{folder}/out", "contract").collect())


@pytest.mark.parametrize("replace", [False, True])
def test_two_loads_at_once(spark, folder, monkeypatch, replace):
    """The second load of a year passes its check before the first is done, and one of them loses."""
    if replace:
        run_year(spark, src_with(f"{folder}/0", award_xml("9")), f"{folder}/out", 2005)
    first, second = (src_with(f"{folder}/{n}", award_xml(str(n))) for n in (1, 2))
    publish = jobs.publish

    def meanwhile(*args):
        monkeypatch.setattr(jobs, "publish", publish)
        run_year(spark, second, f"{folder}/out", 2005, replace=replace)
        return publish(*args)

    monkeypatch.setattr(jobs, "publish", meanwhile)
    with pytest.raises(LoadError, match="exists"):
        run_year(spark, first, f"{folder}/out", 2005, replace=replace)
    assert contract_piids(spark, folder) == ["2"]
    for table in ("contract", "vendor", "rejects"):
        assert len(list(Path(folder, "out", table, "year=2005").iterdir())) == 1 + replace


def test_only_one_of_many_makes_a_file(spark, folder):
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: session.put_if_absent(spark, f"{folder}/a/b.json", f"text {i}"), range(16)))
    assert made.count(True) == 1
    assert session.read_text(spark, f"{folder}/a/b.json") == f"text {made.index(True)}"
    assert [p.name for p in Path(folder, "a").iterdir() if not p.name.endswith(".crc")] == ["b.json"]
    # Told again after an answer was lost, the one that made it still learns that it did.
    assert session.put_if_absent(spark, f"{folder}/a/b.json", f"text {made.index(True)}")


def test_rename_does_not_overwrite(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path
    for name in ("a", "b"):
        Path(folder, name).write_text(name)
    with pytest.raises(Exception, match="exists|Exists"):
        session._rename_to_free_name(spark, path(f"file:{folder}/a"), path(f"file:{folder}/b"))
    session._rename_to_free_name(spark, path(f"file:{folder}/a"), path(f"file:{folder}/c"))
    assert Path(folder, "c").read_text() == "a" and Path(folder, "b").read_text() == "b"


def test_readers_see_a_year_whole_or_not_at_all(spark, folder, monkeypatch):
    run_year(spark, src_with(f"{folder}/a", award_xml("1")), f"{folder}/out", 2004)
    seen = []

    def watched(name):
        step = getattr(jobs, name)

        def run(*args, **kwargs):
            found = step(*args, **kwargs)
            seen.append([years_of(spark, folder, t) for t in ("contract", "vendor")])
            return found

        monkeypatch.setattr(jobs, name, run)

    for name in ("_write_rejects", "_write_widths", "publish"):
        watched(name)
    run_year(spark, src_with(f"{folder}/b", award_xml("2")), f"{folder}/out", 2005)
    assert seen == [[{2004}, {2004}]] * 3 + [[{2004, 2005}] * 2]


STEPS = ["_check_broken", "_write_rejects", "_write_widths", "dedupe_vendors", "publish"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("killed", [False, True])
def test_old_year_stays_whatever_step_fails(spark, folder, monkeypatch, step, killed):
    """An error, or a driver that dies and cleans nothing up: the old year is there, and the next load works."""
    run_year(spark, src_with(f"{folder}/a", award_xml("1")), f"{folder}/out", 2005)
    src = src_with(f"{folder}/b", award_xml("2"))

    def fail(*_args, **_kwargs):
        raise OSError("disk")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, step, fail)
        if killed:
            patch.setattr(jobs, "drop_load", lambda *_: None)
        with pytest.raises(OSError, match="disk"):
            run_year(spark, src, f"{folder}/out", 2005, replace=True)
    assert contract_piids(spark, folder) == ["1"]
    left = snapshots.abandoned_loads(spark, f"{folder}/out", 2005, jobs.TABLES, hours=-1)
    assert bool(left) == (killed and step in STEPS[2:])
    assert not snapshots.abandoned_loads(spark, f"{folder}/out", 2005, jobs.TABLES)
    run_year(spark, src, f"{folder}/out", 2005, replace=True)
    assert contract_piids(spark, folder) == ["2"]


def test_replaced_files_stay_until_they_expire(spark, folder):
    loads = [run_year(spark, src_with(f"{folder}/{n}", award_xml(str(n))), f"{folder}/out", 2005, replace=True) for n in (1, 2, 3)]
    assert all(Path(load.contract).exists() for load in loads)
    gone = snapshots.expire_snapshots(spark, f"{folder}/out", 2005, keep=2)
    assert len(gone) == 3 and [Path(load.contract).exists() for load in loads] == [False, True, True]
    assert contract_piids(spark, folder) == ["3"]
    assert snapshots.expire_snapshots(spark, f"{folder}/out", 2005, keep=2) == []


def test_published_and_plain_years_lie_side_by_side(spark, folder):
    run_year(spark, src_with(folder, award_xml("1")), f"{folder}/out", "all")
    plain = spark.sql("SELECT '7' AS PIID, timestamp_ntz'2001-01-01 00:00:00' AS signedDate")
    write_contract(plain, f"{folder}/out", 2001)
    found = read_table(spark, f"{folder}/out", "contract")
    assert {(r.PIID, r.year) for r in found.collect()} == {("1", "all"), ("7", "2001")}
    with pytest.raises(LoadError, match="exists"):
        run_year(spark, f"{folder}/in", f"{folder}/out", 2001)


def test_failed_load_leaves_nothing_behind(spark, folder, monkeypatch):
    def fail(*_args, **_kwargs):
        raise OSError("disk")

    monkeypatch.setattr(jobs, "dedupe_vendors", fail)
    with pytest.raises(OSError, match="disk"):
        run_year(spark, src_with(folder, award_xml("1")), f"{folder}/out", 2005)
    for table in ("contract", "vendor", "rejects"):
        assert not Path(folder, "out", table, "year=2005").exists()


def test_cuts_and_rejects_are_counted_while_rows_are_written(spark, folder, monkeypatch):
    """No table that is being loaded is read to count anything."""
    monkeypatch.setattr("contractlake.operators.rejects.check_rejects", None)
    monkeypatch.setattr("contractlake.operators.width.cut_counts", None)
    wide = "<ns1:text>123456789</ns1:text>"
    src = src_with(folder, award_xml("1", extra=wide), award_xml("2", extra=wide), broken_amount("3"))
    load = run_year(spark, src, f"{folder}/out", 2005, widths={"text": 4, "vendorName": 9, "PIID": 9})
    assert load.cuts == {"contract": {"text": 2}, "vendor": {}}
    schema = discover_schema(award_records(spark, f"{src}/A-AWARD.xml"))
    empty = run_year(spark, src_with(f"{folder}/e"), f"{folder}/out", 2006, schema=schema, widths={"PIID": 4})
    assert empty.cuts == {"contract": {}, "vendor": {}}


def test_years_with_different_columns(spark, folder):
    src_with(f"{folder}/a", award_xml("1", extra="<ns1:old>1</ns1:old>"))
    src_with(f"{folder}/b", award_xml("2", extra="<ns1:new>2</ns1:new>"))
    sources = {2004: f"{folder}/a/in", 2005: f"{folder}/b/in"}
    loads = run_years(spark, sources, f"{folder}/out", at_once=2)
    assert set(loads) == {2004, 2005}
    table = read_table(spark, f"{folder}/out", "contract")
    assert {(r.year, r.old, r.new) for r in table.collect()} == {(2004, "1", None), (2005, None, "2")}
    with pytest.raises(LoadError):
        run_years(spark, sources, f"{folder}/out")
