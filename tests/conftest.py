import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from parley.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, driver_memory="8g", app="parley-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def rules(spark):
    from parley.operators.sentiment import sentiment_rules
    return sentiment_rules(spark, [("good", 2.0), ("bad", -2.0), ("slow", -1.0), ("thank", 1.5)],
                           negators=["not"], boosters=["very"])


def calls_df(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "call_id bigint, transcript_text string")
