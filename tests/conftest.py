import pytest

from storefront.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "storefront-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """The rows of a DataFrame as sorted tuples."""

    def collect(df, *columns):
        if columns:
            df = df.select(*columns)
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect


@pytest.fixture(autouse=True)
def interpreted_on_tiny_frames(request, spark):
    """Compiling plans takes longer than running them on a handful of rows."""
    tiny = "test_queries" not in request.module.__name__
    spark.conf.set("spark.sql.codegen.wholeStage", not tiny)
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
