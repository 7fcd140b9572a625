import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for p in (ROOT, os.path.join(ROOT, "tests")):
    if p not in sys.path:
        sys.path.insert(0, p)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = os.environ.get("CLICKFEAT_ORACLE_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session", autouse=True)
def small_budgets():
    """Model queries fit 5 rounds here; the catalogue itself runs the full budget."""
    from clickfeat.plans import queries

    queries.FULL = queries.ROUNDS, queries.TRIALS
    queries.ROUNDS = 5


@pytest.fixture(scope="session")
def spark():
    from clickfeat.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, app="clickfeat-tests")
    yield s
    s.stop()
