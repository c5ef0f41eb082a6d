import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cardwise.session import build_session  # noqa: E402

SF_SMALL = os.environ.get("CARDWISE_TEST_SF", "/root/testdata/sf0.001")
T0 = 1_700_000_000_000


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def txn_rows(spec):
    """Rows of the canonical schema from (txn_id, card, ts_ms, amount, mcc, merchant, lat, lon)."""
    out = []
    for r in spec:
        txn_id, card, ts, amount, mcc, merchant, lat, lon = r
        out.append((txn_id, card, int(ts), float(amount), mcc, merchant, float(lat), float(lon), 0))
    return out


@pytest.fixture
def make_txn(spark):
    from cardwise.schema import TXN_SCHEMA

    def make(spec):
        return spark.createDataFrame(txn_rows(spec), TXN_SCHEMA)

    return make
