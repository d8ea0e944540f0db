import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def log_dir(tmp_path_factory):
    return str(tmp_path_factory.mktemp("eventlogs"))


@pytest.fixture(scope="session")
def spark(log_dir):
    from ledgerlake.session import build_session

    # the session writes its own event log, which the log operators then read
    session = build_session(
        "tests", 8, "6g",
        {
            "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + log_dir,
            "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false", "spark.eventLog.buffer.kb": "4k",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def silver(spark):
    from ledgerlake.plans.silver import build_silver
    from ledgerlake.sources.derived import raw_feeds

    return build_silver(raw_feeds(spark, SF))


@pytest.fixture(scope="session")
def gold(silver):
    from ledgerlake.plans.gold import build_gold
    from ledgerlake.session import stage

    return stage(build_gold(silver), "gold")


def plan(df, mode="formatted"):
    return df._jdf.queryExecution().explainString(
        df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


@pytest.fixture(scope="session")
def plan_of():
    return plan


@pytest.fixture(scope="session")
def nodes_of():
    """Names of a plan's physical operators."""
    import re

    def names(df):
        return {m.group(1) for m in re.finditer(r"^[\s:|+\-*]*(?:\(\d+\) )?([A-Za-z]+)", plan(df, "simple"), re.M)}

    return names
