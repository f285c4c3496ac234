"""What must not be sent to the driver, however small Spark takes it to be."""

from tallyhouse.llm import simhash
from tallyhouse.session import settle


def test_cells_are_not_broadcast(spark):
    """A fingerprint lies in 70 cells; Spark sizes them as one."""
    nodes = settle(spark.createDataFrame([(i * 0x9E3779B97F4A7C15 % (1 << 63),) for i in range(300)] + [(0,), (3,), (1 << 40,)], "fp long"))
    found = simhash.links(nodes)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    near = [(r["u"], r["v"]) for r in found.collect()]
    assert near and all((u ^ v).bit_count() <= simhash.REACH for u, v in near)
    assert {0, 3, 1 << 40} <= {n for link in near for n in link}
