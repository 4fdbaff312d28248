from pathlib import Path
import sys

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from claimspan.session import build_session

    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "claimspan-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
        spark__sql__warehouse__dir=str(base / "warehouse"),
        spark__checkpoint__dir=str(base / "shared"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    old = {}

    def change(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            old[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in old.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
