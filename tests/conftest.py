import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from turnstile.session import build_session, shared_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    shared_folder(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows_of():
    def collect(df, *columns):
        """Rows as a sorted list of tuples; missing values sort first."""
        picked = df.select(*[f"`{c}`" for c in columns]) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, str(v)) for v in t])

    return collect
