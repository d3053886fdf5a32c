import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from feedlake.session import local_session
    from feedlake.workspace import shared_dir

    s = local_session("*", 8, "feedlake-tests")
    shared_dir(s)  # the session's shared folder, or a fresh one of our own when it names none
    yield s


@pytest.fixture(scope="module", autouse=True)
def no_views_left(request):
    """Temporary views of one module's tests are not seen by the next module's: they share the session."""
    yield
    from pyspark.sql import SparkSession

    s = SparkSession.getActiveSession()
    for view in s.sql("SHOW VIEWS").where("isTemporary").collect() if s else ():
        s.catalog.dropTempView(view.viewName)


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
