"""Award XML: attributes, leading zeros, absent elements, bad records, both ways of reading."""

import random
from pathlib import Path

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from contractlake.functions.keys import award_key
from contractlake.operators.flatten import column, leaf_paths
from contractlake.plans.tables import contract_projection
from contractlake.sources.awards import (
    CORRUPT,
    UNENDED,
    RecordCutter,
    award_files,
    award_records,
    cut_pieces,
    discover_schema,
    read_awards,
)

from conftest import award_xml, plan_of, rows, write_awards

MODES = ("files", "records")


@pytest.mark.parametrize("mode", MODES)
def test_attributes_zeros_and_text_stay_as_written(spark, folder, mode):
    text = "<ns1:note>a &lt;b&gt; &amp; é€😀</ns1:note>"
    write_awards(f"{folder}/A-AWARD.xml", [award_xml("1", mod="00", extra=text)])
    awards = read_awards(spark, award_files(folder), mode=mode)
    assert "_version" not in awards.columns
    row = contract_projection(award_key(awards)).first()
    assert (row.agencyID, row.DUNSNumber, row.modNumber) == ("0300", "012345678", "00")
    assert row.unique_award_id == "1_0300_00_0"
    assert row.note == "a <b> & é€😀"


def test_inferred_types_lose_leading_zeros(spark, folder):
    write_awards(f"{folder}/A-AWARD.xml", [award_xml("1")])
    awards = read_awards(spark, award_files(folder), infer_types=True)
    assert contract_projection(award_key(awards)).first().agencyID == 300


@pytest.mark.parametrize("mode", MODES)
def test_only_award_files_are_read(spark, folder, mode):
    write_awards(f"{folder}/A-AWARD.xml", [award_xml("1")])
    write_awards(f"{folder}/B-IDV.xml", [award_xml("2")])
    assert read_awards(spark, award_files(folder), mode=mode).count() == 1


@pytest.mark.parametrize("mode", MODES)
def test_absent_vehicle_gives_null_key(spark, folder, mode):
    write_awards(f"{folder}/x/A-AWARD.xml", [award_xml("1"), award_xml("2", vehicle="IDV")])
    write_awards(f"{folder}/y/A-AWARD.xml", [award_xml("3")])
    some = award_key(read_awards(spark, f"{folder}/x/*AWARD.xml", mode=mode))
    none = award_key(read_awards(spark, f"{folder}/y/*AWARD.xml", mode=mode))
    key = F.col("`ns1:referencedID`")
    assert {r[0] for r in some.select(key).collect()} == {None, "IDV_9700_0"}
    assert [r[0] for r in none.select(key).collect()] == [None]


@pytest.mark.parametrize("mode", MODES)
def test_empty_part_gives_null_key_and_empty_duns_null(spark, folder, mode):
    write_awards(f"{folder}/A-AWARD.xml", [award_xml("1", mod="", duns=""), award_xml("2")])
    contract = contract_projection(award_key(read_awards(spark, award_files(folder), mode=mode)))
    found = {r.PIID: (r.unique_award_id, r.DUNSNumber) for r in contract.collect()}
    assert found == {"1": (None, None), "2": ("2_0300_00_0", "012345678")}


@pytest.mark.parametrize("mode", MODES)
def test_repeated_element_becomes_array(spark, folder, mode):
    tags = "<ns1:tag>a</ns1:tag><ns1:tag>b</ns1:tag>"
    write_awards(f"{folder}/A-AWARD.xml", [award_xml("1", extra=tags), award_xml("2")])
    awards = read_awards(spark, award_files(folder), mode=mode)
    assert awards.schema["ns1:tag"].dataType == T.ArrayType(T.StringType())
    kept = {tuple(r[0] or ()) for r in awards.select(F.col("`ns1:tag`")).collect()}
    assert kept == {("a", "b"), ()}


def _broken(folder):
    bad = award_xml("3").replace("</ns1:PIID>", "</ns1:PID>", 1)
    records = [award_xml("1"), award_xml("2"), bad, award_xml("4")]
    return write_awards(f"{folder}/A-AWARD.xml", records)


def test_bad_record_costs_only_itself_when_read_as_records(spark, folder):
    awards = read_awards(spark, _broken(folder), mode="records").cache()
    piid = column("ns1:awardID.ns1:awardContractID.ns1:PIID")
    good = awards.where(F.col(CORRUPT).isNull()).select(piid)
    assert {r[0] for r in good.collect()} == {"1", "2", "4"}
    corrupt = awards.where(F.col(CORRUPT).isNotNull()).collect()
    assert len(corrupt) == 1 and "<ns1:PIID>3" in corrupt[0][CORRUPT]


def test_bad_record_costs_rest_of_file_when_read_as_file(spark, folder):
    path = _broken(folder)
    schema = discover_schema(award_records(spark, path))
    awards = read_awards(spark, path, schema).cache()
    assert awards.where(F.col(CORRUPT).isNull()).count() == 2
    assert awards.where(F.col(CORRUPT).isNotNull()).count() == 1


def test_both_ways_agree_over_split_files(spark, folder):
    """Splits far smaller than the file: every record is read exactly once."""
    records = [award_xml(str(i), vehicle="I" if i % 3 else None) for i in range(3000)]
    path = write_awards(f"{folder}/A-AWARD.xml", records)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        by_record = read_awards(spark, path, mode="records")
        assert by_record.rdd.getNumPartitions() > 10
        by_file = read_awards(spark, path)
        assert rows(contract_projection(award_key(by_record))) == rows(
            contract_projection(award_key(by_file))
        )
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_discovered_schema_equals_inferred_one(spark, folder):
    extra = "<ns1:m><ns1:p>1</ns1:p><ns1:p>2</ns1:p></ns1:m><ns1:empty/>"
    write_awards(f"{folder}/A-AWARD.xml", [award_xml("1", vehicle="X"), award_xml("2", extra=extra)])
    found = discover_schema(award_records(spark, award_files(folder)))
    inferred = read_awards(spark, award_files(folder)).drop(CORRUPT).schema
    assert found == inferred
    assert ("ns1:m", "ns1:p") in leaf_paths(found)


def test_text_beside_child_elements_is_kept(spark, folder):
    mixed = "<ns1:m>own<ns1:p>1</ns1:p></ns1:m>"
    write_awards(f"{folder}/A-AWARD.xml", [award_xml("1", extra=mixed)])
    found = read_awards(spark, award_files(folder), mode="records").select(column("ns1:m")).first()[0]
    assert found.asDict() == {"_VALUE": "own", "ns1:p": "1"}


@pytest.mark.parametrize("mode", MODES)
def test_records_without_content_cost_no_other_record(spark, folder, mode):
    empty = ["<ns1:award/>", '<ns1:award version="1" />']
    records = [award_xml("1"), *empty, award_xml("2"), award_xml("3"), *empty]
    path = write_awards(f"{folder}/A-AWARD.xml", records)
    awards = read_awards(spark, path, mode=mode)
    piid = column("ns1:awardID.ns1:awardContractID.ns1:PIID")
    found = sorted(str(r[0]) for r in awards.select(piid).collect())
    assert found == ["1", "2", "3", "None", "None", "None", "None"]


AWKWARD = [
    award_xml("1"),
    award_xml("2").replace("</ns1:award>", "</ns1:award\t>"),
    f"<!-- {award_xml('80')} and {award_xml('81')} -->",
    award_xml("3", extra="<ns1:n><![CDATA[x </ns1:award> <ns1:award> y]]></ns1:n>"),
    award_xml("4", extra="<!-- </ns1:award> --><ns1:n>z</ns1:n>"),
    '<ns1:award version=">"/>',
    award_xml("5"),
]


def piids(awards):
    return sorted(str(r[0]) for r in awards.select(column("ns1:awardID.ns1:awardContractID.ns1:PIID")).collect())


def test_both_ways_agree_on_awkward_but_valid_files(spark, folder):
    path = write_awards(f"{folder}/A-AWARD.xml", AWKWARD)
    found = [read_awards(spark, path, mode=mode) for mode in MODES]
    assert piids(found[0]) == piids(found[1]) == ["1", "2", "3", "4", "5", "None"]
    assert found[1].where(F.col(CORRUPT).isNotNull()).count() == 0


def test_every_start_tag_is_a_row(spark, folder):
    """Records without an end tag, inside the file and at its end, are corrupt rows."""
    torn = award_xml("2").replace("</ns1:award>", "")
    path = write_awards(f"{folder}/A-AWARD.xml", [award_xml("1"), torn, award_xml("3")])
    whole = open(path).read()
    with open(path, "w") as file:
        file.write(whole + award_xml("4")[:-30])
    records = award_records(spark, path)
    assert sorted((r.error, r.value[-12:]) for r in records.where("error IS NOT NULL").collect())
    awards = read_awards(spark, path, mode="records")
    good = awards.where(F.col(CORRUPT).isNull())
    assert piids(good) == ["1", "3"] and awards.count() == 4


def test_file_that_ends_with_an_end_tag(spark, folder):
    with open(f"{folder}/A-AWARD.xml", "w") as file:
        file.write(award_xml("1") + award_xml("2"))
    assert piids(read_awards(spark, f"{folder}/A-AWARD.xml", mode="records")) == ["1", "2"]


def test_encoding_is_declared_or_corrupt(spark, folder):
    text = '<?xml version="1.0" encoding="ISO-8859-1"?>\n<r>' + award_xml("1", extra="<ns1:n>caf\u00e9</ns1:n>") + "</r>"
    with open(f"{folder}/A-AWARD.xml", "wb") as file:
        file.write(text.encode("latin-1"))
    path = f"{folder}/A-AWARD.xml"
    right = read_awards(spark, path, mode="records", encoding="iso-8859-1")
    assert right.select("`ns1:n`").first()[0] == read_awards(spark, path).select("`ns1:n`").first()[0] == "caf\u00e9"
    wrong = read_awards(spark, path, right.schema, mode="records")
    assert wrong.where(F.col(CORRUPT).isNull()).count() == 0 and wrong.count() == 1


@pytest.fixture()
def split_size(spark):
    """Sets how many bytes of a file a task reads."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    yield lambda size: spark.conf.set(name, str(size))
    spark.conf.set(name, before)


def plain_records(text, tag="a"):
    """What one cutter makes of the whole text."""
    pieces = text.split(f"</{tag}>")
    return list(cut_pieces([(p, True) for p in pieces[:-1]] + [(pieces[-1], False)], tag))


def random_text(rng, kinds):
    """Records, sections and what may be wrong with them, most of them longer than a split."""
    def filler():
        return "".join(rng.choice("xy z\n\u00e9") for _ in range(rng.randrange(60)))

    tokens = ["<a>", '<a b="1 > 0">', "</a>", "</a >", "<a/>", "<ab>", "</ab>", "<!--", "-->", "<![CDATA[", "]]>", "<!-- </a> <a> -->", "]", "--"]
    weights = [6, 1, 8, 1, 1, 1, 1, *([kinds] * 4), kinds, 1, 1]
    return "".join(t + filler() for t in rng.choices(tokens, weights, k=rng.randrange(60)))


@pytest.mark.parametrize("size", [60, 150, 700])
def test_borders_of_splits_change_nothing(spark, folder, split_size, size):
    """Random files, some with sections over many splits, some with one that never ends."""
    rng = random.Random(size)
    want = []
    for i in range(24):
        text = random_text(rng, (0, 0.5, 2)[i % 3])
        path = Path(folder, f"{i}.xml")
        path.write_text(text)
        want += [(path.as_uri().replace("file:///", "file:/"), *row) for row in plain_records(text)]
    key = lambda r: tuple(map(str, r))
    found = {}
    for n in (size, 10**8):
        split_size(n)
        records = award_records(spark, f"{folder}/*.xml", "a")
        found[n] = sorted([(r.file.replace("file:///", "file:/"), r.value, r.error) for r in records.collect()], key=key)
    assert sum(r[2] == UNENDED for r in want) > 3 and sum(r[2] is None for r in want) > 20
    assert found[10**8] == sorted(want, key=key)
    assert found[size] == found[10**8]


@pytest.mark.parametrize("ended", [True, False])
def test_section_over_the_border_of_splits(spark, folder, split_size, ended):
    """Records in a comment over many splits are none; if it does not end, that is one row of its text."""
    many = [award_xml(str(i)) for i in range(400)]
    path = write_awards(f"{folder}/A-AWARD.xml", [award_xml("900"), "<!--", *many, "-->" if ended else "", award_xml("901")])
    split_size(50_000)
    found = award_records(spark, path)
    bad = found.where("error IS NOT NULL").collect()
    assert found.where("error IS NULL").count() == 1 + ended
    assert [r.error for r in bad] == [UNENDED] * (not ended)
    assert all(r.value.startswith("<!--") and r.value.endswith("</ns1:award>") and len(r.value) < 2000 for r in bad)


def test_record_with_a_section_over_several_splits_is_whole(spark, folder, split_size):
    note = "<ns1:n><![CDATA[" + " ".join(f"{i} </ns1:award> <ns1:award>" for i in range(3000)) + "]]></ns1:n>"
    records = [award_xml("1"), award_xml("2", extra=note), award_xml("3"), award_xml("4", extra=note)]
    path = write_awards(f"{folder}/A-AWARD.xml", records)
    split_size(20_000)
    awards = read_awards(spark, path, mode="records")
    assert piids(awards) == ["1", "2", "3", "4"] and awards.where(F.col(CORRUPT).isNotNull()).count() == 0
    notes = {r[0] for r in awards.select("`ns1:n`").collect()}
    assert notes == {None, note[len("<ns1:n><![CDATA[") : -len("]]></ns1:n>")]}


def test_file_that_ends_with_an_end_tag_over_several_splits(spark, folder, split_size):
    text = "".join(award_xml(str(i)) for i in range(200))
    Path(folder, "A-AWARD.xml").write_text(text)
    Path(folder, "B-AWARD.xml").write_text(text + award_xml("200")[:-40])
    split_size(10_000)
    records = award_records(spark, f"{folder}/*AWARD.xml")
    assert records.where("error IS NULL").count() == 400
    assert [r.error for r in records.where("error IS NOT NULL").collect()] == ["no end tag"]


def test_every_split_of_a_file_in_another_encoding_says_so(spark, folder, split_size):
    head = '<?xml version="1.0" encoding="{}"?>\n<r>'
    records = "".join(award_xml(str(i), extra="<ns1:n>caf\u00e9</ns1:n>") for i in range(100))
    Path(folder, "A-AWARD.xml").write_bytes((head.format("windows-1252") + records + "</r>").encode("cp1252"))
    Path(folder, "B-AWARD.xml").write_bytes((head.format("UTF8") + records + "</r>").encode())
    split_size(10_000)
    found = award_records(spark, f"{folder}/*AWARD.xml").groupBy("error").count().collect()
    assert {(r.error, r["count"]) for r in found} == {("the file declares windows-1252", 100), (None, 100)}
    found = award_records(spark, f"{folder}/*AWARD.xml", encoding="cp1252").groupBy("error").count().collect()
    assert {(r.error, r["count"]) for r in found} == {("the file declares UTF8", 100), (None, 100)}


def test_tidy_files_meet_no_python(spark, folder):
    """Attributes, records without content, whole sections, prolog comments and several splits included."""
    extra = "<ns1:n><![CDATA[a < b]]></ns1:n><!-- seen -->"
    many = ["<!-- made by hand -->", *[award_xml(str(i), extra=extra if i % 3 else "") for i in range(50)], "<!-- the end -->"]
    path = write_awards(f"{folder}/A-AWARD.xml", many)
    assert "Python" not in (plan := plan_of(read_awards(spark, path, mode="records"))) and "Pandas" not in plan
    assert read_awards(spark, path, mode="records").where(F.col(CORRUPT).isNull()).count() == 50
    untidy = write_awards(f"{folder}/B-AWARD.xml", [*many, award_xml("77").replace("</ns1:award>", "</ns1:award >")])
    awards = read_awards(spark, [path, untidy], mode="records")
    assert "Pandas" in plan_of(awards) and awards.count() == 101


MIXED = [
    "<a><b>1</b><t>x</t></a>",
    "<a v='>'><b>2</b><t>x</t><t>y</t><s>text<q>1</q></s></a>",
    "<a><b x='1>0'><c>1</c></b><e/><z><y/></z><w><y>\n</y></w></a>",
    "<a><b>",
    "<a><g><h>1</h></g><g><h>1</h><h>2</h></g><sp>  </sp><k><![CDATA[<no>]]></k><!-- <no>1</no> --><l><m/><![CDATA[ x ]]></l></a>",
    "<a>own text<b/></a>",
]


def test_discovered_tree_joins_all_shapes_of_an_element(spark):
    found = discover_schema(spark.createDataFrame([(r,) for r in MIXED], "value string"))
    want = (
        "struct<b:struct<_VALUE:string,c:string>,e:string,g:array<struct<h:array<string>>>,k:string,"
        "l:struct<_VALUE:string,m:string>,s:struct<_VALUE:string,q:string>,sp:string,t:array<string>,w:struct<y:string>,z:struct<y:string>>"
    )
    assert found.simpleString() == want
    assert discover_schema(spark.createDataFrame([], "value string")) == T.StructType([])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<a>", "</a>", "</a >", "<a/>", "x", "<!--", "-->", "<![CDATA[", "]]>", "-", "<b>"]), max_size=14))
def test_pieces_change_nothing(tokens):
    text = "".join(tokens)
    parts = text.split("</a>")
    pieces = [(p, True) for p in parts[:-1]] + [(parts[-1], False)]
    cutter = RecordCutter("a")
    assert list(cut_pieces(pieces, "a")) == [*cutter._scan(text, 0, None, True), *cutter.finish()]


def test_no_file_raises(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_awards(spark, award_files(folder))
