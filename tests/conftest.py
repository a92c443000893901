from __future__ import annotations

import pytest

from matchday.session import local_session

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    metastore = tmp_path_factory.mktemp("metastore")
    session = local_session(
        4, "tests", 4,
        **{
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={metastore}",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def rows():
    """Collected rows as dicts, sorted by the given columns."""

    def collect(df, *order):
        out = [r.asDict(recursive=True) for r in df.collect()]
        return sorted(out, key=lambda r: tuple(str(r[c]) if r[c] is None else r[c] for c in order)) if order else out

    return collect
