import pytest

from tallybook.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    return local_session(8, memory="8g", **{"spark.checkpoint.dir": str(scratch)})


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of plain tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
