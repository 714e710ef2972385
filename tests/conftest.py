import pytest

from tallygraph.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", 4, spark__ui__enabled="false", spark__ui__showConsoleProgress="false"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted plain rows of a frame."""

    def get(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return get
