import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("TZ", "UTC")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from changeflow.session import local_session
    base = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, "tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": base, "spark.sql.warehouse.dir": f"{base}/warehouse"})
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A new path below the shared folder."""
    from changeflow.session import scratch_dir
    return scratch_dir(spark, "t" + uuid.uuid4().hex[:6])


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
