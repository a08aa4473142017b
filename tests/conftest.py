import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from turnwarden.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getConf().get("spark.checkpoint.dir"):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def screen(spark):
    """Apply an operator to texts; returns (events, blocked_by, text) per text."""
    def run(operator, *texts, **kwargs):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "turn_id long, text string")
        rows = operator(df, **kwargs).orderBy("turn_id").collect()
        found = [([(e.number, e.action, e.detail) for e in r.decisions], r.blocked_by, r.text) for r in rows]
        return found[0] if len(found) == 1 else found
    return run
