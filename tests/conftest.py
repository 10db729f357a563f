import sys
import tempfile
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from caseledger.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="spark-")
    session = build_session("tests", "local[8]", settings={
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": f"{folder}/checkpoints",
        "spark.sql.warehouse.dir": f"{folder}/warehouse"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def name():
    """Fresh table names."""
    return lambda base: f"{base}_{uuid.uuid4().hex[:10]}"


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df, *columns):
    """Sorted plain tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()),
                  key=lambda row: tuple((v is not None, str(v)) for v in row))
