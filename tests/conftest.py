import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("contractlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture()
def folder():
    """A new folder per test, left in place."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def award_xml(
    piid="1", agency="0300", mod="00", transaction="0", duns="012345678", vehicle=None, extra=""
):
    """One hand-written award element."""
    idv = ""
    if vehicle:
        idv = (
            f"<ns1:referencedIDVID><ns1:PIID>{vehicle}</ns1:PIID><ns1:agencyID>9700</ns1:agencyID>"
            "<ns1:modNumber>0</ns1:modNumber></ns1:referencedIDVID>"
        )
    return (
        '<ns1:award version="1.4"><ns1:awardID><ns1:awardContractID>'
        f'<ns1:PIID>{piid}</ns1:PIID><ns1:agencyID name="N">{agency}</ns1:agencyID>'
        f"<ns1:modNumber>{mod}</ns1:modNumber>"
        f"<ns1:transactionNumber>{transaction}</ns1:transactionNumber></ns1:awardContractID>{idv}"
        "</ns1:awardID><ns1:relevantContractDates><ns1:signedDate>2004-10-0"
        f"{1 + int(piid) % 9} 00:00:00</ns1:signedDate></ns1:relevantContractDates>"
        f"<ns1:dollarValues><ns1:obligatedAmount>{piid}.50</ns1:obligatedAmount></ns1:dollarValues>"
        f"{extra}<ns1:vendor><ns1:vendorHeader><ns1:vendorName>V{piid}</ns1:vendorName>"
        "</ns1:vendorHeader><ns1:vendorSiteDetails><ns1:vendorDUNSInformation>"
        f"<ns1:DUNSNumber>{duns}</ns1:DUNSNumber></ns1:vendorDUNSInformation>"
        "</ns1:vendorSiteDetails></ns1:vendor></ns1:award>"
    )


def write_awards(path, records, root='ns1:awards xmlns:ns1="urn:awards"'):
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    body = "\n".join(records)
    path.write_text(f'<?xml version="1.0"?>\n<{root}>\n{body}\n</{root.split()[0]}>\n')
    return str(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    names = sorted(df.columns)
    return sorted((tuple(str(r[n]) for n in names) for r in df.collect()))
