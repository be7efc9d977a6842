"""Connected components of a link table, as alternating star joins.

Links and labels stay in distributed tables; the driver sees two numbers a
round. The minimum of each neighbourhood is written before it is joined back,
so that both sides of the join are plain shuffles that AQE splits when one
node (the centre of a large star) has a large share of the links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import pin


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(links: DataFrame, a: str = "a", b: str = "b",
                         max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node with a link; ``component`` is the
    smallest node that links reach. Null ends and loops are ignored; repeated
    links count once; no links give no rows. Fails if ``max_rounds`` do not
    suffice, rather than return labels that are not final."""
    cur = pin(links.where(F.col(a) != F.col(b))
              .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = _state(cur)
    if not state[0]:
        return cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        both = cur.unionAll(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = pin(both.groupBy("u").agg(F.min("v").alias("m"))
                    .select("u", F.least("u", "m").alias("m")))
        large = pin(both.where(F.col("v") > F.col("u")).join(least, "u")
                    .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = pin(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (large.join(least, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        nxt = pin(small.unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        new = _state(nxt)
        if new == state:
            roots = nxt.select(F.col("v").alias("node")).distinct()
            return (nxt.select(F.col("u").alias("node"), F.col("v").alias("component"))
                    .unionAll(roots.select("node", F.col("node").alias("component"))))
        cur, state = nxt, new
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
