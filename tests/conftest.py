import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from natalis.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    spark = session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__sql__warehouse__dir=str(root / "warehouse"),
        spark__checkpoint__dir=str(root / "checkpoints"),
        spark__driver__memory="6g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
