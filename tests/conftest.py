import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from patronage.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("patronage-tests", cpus=8)
    yield session
    session.stop()


@pytest.fixture()
def setting(spark):
    """Change session settings for one test."""
    before = {}

    def change(key, value):
        before.setdefault(key, spark.conf.get(key))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture(params=[("1", "true"), ("7", "false"), ("13", "true")], ids=["1-aqe", "7-plain", "13-aqe"])
def layout(request, setting):
    """Run a test under several partition counts, with and without adaptive execution."""
    partitions, adaptive = request.param
    setting("spark.sql.shuffle.partitions", partitions)
    setting("spark.sql.adaptive.enabled", adaptive)
    return request.param
