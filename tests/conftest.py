import pytest

from quillgraph.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(4, 4, "2g")


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
