import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from verification.check import local_session  # noqa: E402
from waterline.config import RunConfig  # noqa: E402

CONTRACT_DDL = (
    "account_number string, package_group string, start_date date, end_date date,"
    " price decimal(18,2), wo_type_group string, reason_group string, test_flag int,"
    " cxn_code int, site string"
)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cfg():
    return RunConfig(as_of=dt.date(2024, 6, 15), core_packages=("P", "Q"))


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


def contract(
    account="A1",
    package="P",
    start="2024-01-01",
    end=None,
    price="10.00",
    wo="Activate",
    reason="Other",
    test=0,
    code=5,
    site="1",
):
    return (
        account, package, day(start), day(end), Decimal(price), wo, reason, test, code, site,
    )


@pytest.fixture(scope="session")
def contracts(spark):
    def make(*rows):
        return spark.createDataFrame(list(rows), CONTRACT_DDL)

    return make


def as_dicts(df):
    return [r.asDict() for r in df.collect()]
