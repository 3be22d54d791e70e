import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluice.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", app="sluice-tests", shuffle_partitions=8)
    # tests have no cluster-provided shared folder: use a private one
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sluice-test-"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def plan_text(df) -> str:
    """The formatted physical plan, as ``explain`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow",
                "FlatMapGroupsInPandas", "AggregateInPandas", "WindowInPandas")


def python_nodes(df) -> list[str]:
    """Python execution nodes in the physical plan (empty = all JVM)."""
    text = plan_text(df)
    return [n for n in PYTHON_NODES if n in text]
