import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from inkfold.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build(
        "local[4]",
        "tests",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="3g",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
