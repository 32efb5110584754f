"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the (a, b) links; root is the smallest node it reaches.

    Each round joins every node's larger neighbours to its smallest one (large star) and then its
    smaller ones (small star), until nothing changes; the number of rounds grows with the logarithm
    of the longest chain. A hot node's links are pre-aggregated to one minimum per task before they
    are shuffled, and the join back to its links is one that Spark can split. Every round is written
    to the shared folder, so lineage stays short. Null ends and self links are left out.
    """
    current = written(
        links.selectExpr("least(a, b) AS lo", "greatest(a, b) AS hi").where("lo < hi").distinct(), "links"
    )
    state = None
    for _ in range(most_rounds):
        ways = current.selectExpr("lo AS u", "hi AS v").union(current.selectExpr("hi AS u", "lo AS v"))
        least = ways.groupBy("u").agg(F.min("v").alias("low")).selectExpr("u", "least(u, low) AS m")
        large = ways.where("v > u").join(least, "u").selectExpr("m AS lo", "v AS hi").where("lo < hi").distinct()
        # small star: of hi's smaller neighbours, all but the least are linked to the least
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").selectExpr("m AS lo", "CASE WHEN lo = m THEN hi ELSE lo END AS hi")
        current = written(small.where("lo < hi").distinct(), "links")
        # sums of hashes tell whether the set of links is still the same
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = current.selectExpr("hi AS node", "lo AS root")
    return roots.union(current.selectExpr("lo AS node", "lo AS root").distinct())
