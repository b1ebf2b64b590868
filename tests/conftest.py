import tempfile

import pytest

from brindle.session import build


@pytest.fixture(scope="session")
def spark():
    session = build(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=tempfile.mkdtemp(prefix="tests-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def rows(df, *columns):
    """Sorted tuples of a small result."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
