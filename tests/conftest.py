import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gristmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="6g", spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=f"file://{folder}/steps",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as sorted tuples, NULLs last."""
    got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(got, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def same(left, right):
    """Assert that two DataFrames hold the same rows."""
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert rows(left, *columns) == rows(right, *columns)
