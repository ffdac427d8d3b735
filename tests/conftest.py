import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import get_spark
    root = tempfile.mkdtemp(prefix="quarry-tests-")
    s = get_spark("local[*]", 8, app_name="quarry-tests", extra={
        "spark.sql.warehouse.dir": os.path.join(root, "warehouse"),
        "spark.checkpoint.dir": os.path.join(root, "checkpoints"),
    })
    yield s
    s.stop()


@pytest.fixture()
def fresh_db(spark):
    """Unique bronze/silver/meta database names per test (tables do not leak across tests)."""
    import uuid
    tag = uuid.uuid4().hex[:8]
    names = {k: f"{k}_{tag}" for k in ("bronze", "silver", "gold", "meta")}
    for n in names.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {n}")
    return names
