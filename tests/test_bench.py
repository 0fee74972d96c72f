import bench
from tidemark.plans import catalog


def test_headlines_are_queries():
    assert set(bench.HEADLINES) <= set(catalog.queries())
