import pytest

from comarca.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def as_set(df, *columns):
    return {tuple(row) for row in df.select(*columns or df.columns).collect()}


def as_rows(df):
    return [tuple(row) for row in df.collect()]
