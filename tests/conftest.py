import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = Path("/root/testdata")
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="session")
def spark():
    from claimloom.session import build_session

    scratch = tempfile.mkdtemp(prefix="claimloom-test-")
    session = build_session(
        "claimloom-tests",
        master=f"local[{os.environ.get('TEST_CPUS', '8')}]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": f"{scratch}/checkpoints",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
