import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from mailweave.session import build_session

TESTDATA = Path(os.environ.get("TESTDATA_DIR", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "mailweave-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = TESTDATA / "sf0.001"
    if not path.is_dir():
        pytest.skip("no test data")
    return str(path)


@pytest.fixture(scope="session")
def parsed(spark, sf_dir):
    """Parsed mails of the smallest corpus, kept as a table."""
    from mailweave.operators import parse_messages
    from mailweave.session import stage_path
    from mailweave.sources import orders_mail

    path = stage_path(spark, "parsed")
    parse_messages(orders_mail.messages(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)
