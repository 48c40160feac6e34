"""Connected components by minimum labels and pointer jumping, every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirelight.llm.common import HOT_ROWS, bit_filter, spread_join, stored

ROUNDS = 60


def _many(rows: DataFrame, key: str) -> DataFrame:
    """A filter for the keys of more than HOT_ROWS rows."""
    return bit_filter(rows.groupBy(F.col(key).alias("hot_key")).count().where(F.col("count") > HOT_ROWS).select("hot_key"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """edges: a, b (any orderable type). Returns node, root for each node of an edge; root is its component's least
    node. Labels spread along edges and then along labels, so a path of n nodes takes about log2(n) rounds. A hub's edges
    and a large component's labels are dealt over many tasks."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b")
    both = stored(both.distinct(), f"{name}-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("root")), name)
    hubs = _many(both, "a")
    for _ in range(ROUNDS):
        near = spread_join(both, "b", "a", labels.withColumnRenamed("node", "n"), "n", hubs).groupBy("a").agg(F.min("root").alias("near"))
        spread = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("root").alias("old"), F.least("root", "near").alias("next"))
        spread = stored(spread, name)
        jump = labels.select(F.col("node").alias("j_node"), F.col("root").alias("j_root"))
        after = spread_join(spread, "next", "node", jump, "j_node", _many(spread, "next"))
        after = stored(after.select("node", F.least("next", "j_root").alias("root"), (F.least("next", "j_root") < F.col("old")).alias("moved")), name)
        labels = after.select("node", "root")
        if not after.where("moved").limit(1).count():
            return labels
    raise RuntimeError(f"no fixed point in {ROUNDS} rounds")
