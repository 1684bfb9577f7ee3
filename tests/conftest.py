import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from edgeframe.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

GRAPHS = {
    "two_triangles": [(1, 2), (2, 3), (3, 4), (4, 5), (5, 6), (6, 4), (3, 1)],
    "cycles_and_tail": [(1, 2), (2, 3), (3, 4), (4, 1), (1, 5), (5, 6), (6, 7), (7, 8), (8, 9),
                        (6, 10), (10, 5)],
    "diamond": [(1, 2), (1, 3), (2, 4), (3, 4), (4, 1)],
    "self_loop": [(1, 1), (1, 2), (2, 1)],
    "multi_edge": [(1, 2), (1, 2), (2, 3), (3, 1)],
    "island": [(1, 2), (3, 4)],
}


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, app="edgeframe-tests")
    yield s


def make_edges(spark, pairs):
    return spark.createDataFrame(pairs, "src BIGINT, dst BIGINT")


@pytest.fixture
def graph(spark):
    return lambda name: make_edges(spark, GRAPHS[name])
