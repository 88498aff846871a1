import tempfile

import pytest

from medalstar.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("medalstar-tests", "4", **{
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-warehouse-"),
        "spark.sql.debug.maxToStringFields": "1000",  # plan tests look at whole column lists
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")
