import os
import sys
import tempfile
from datetime import date, datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from yardstar.config import LoadConfig  # noqa: E402
from yardstar.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "yardstar-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__driver__host="127.0.0.1",
        spark__driver__bindAddress="127.0.0.1",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def golden(spark):
    from yardstar.plans.pipeline import load
    from yardstar.sources.golden import golden_staging
    from yardstar.sources.store import Store

    cfg = LoadConfig(as_of=date(2026, 4, 28), batch_ts=datetime(2026, 4, 28, 6))
    store = Store(spark, tempfile.mkdtemp(prefix="yardstar-golden-"))
    return load(golden_staging(spark), store, cfg)
