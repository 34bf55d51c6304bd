import pytest

from tarmac.session import local_session
from tarmac.sources.warehouse import Warehouse


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tests", memory="6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def landing(tmp_path):
    return str(tmp_path / "landing")


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))
