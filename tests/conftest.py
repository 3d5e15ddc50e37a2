import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from kpiweave.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            # Tiny frames: compiling costs more than it saves. The query comparison runs compiled.
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples of the given columns."""

    def collect(df, *columns):
        picked = df.select(*[f"`{c}`" for c in columns]) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is not None, str(x)) for x in t))

    return collect
