"""Connected components of an edge table by alternating star contraction.

Every round hangs each node's larger neighbours on its smallest one (large
star), then its smaller neighbours (small star), until every component is a
star, which one aggregation tells. A round is two aggregations and two joins
over the edges; hub nodes are split by the skew join. Lineage is cut each round
with a reliable checkpoint.

Edge tables are small beside the documents, but every shuffle of a round leaves
files in all its tasks: tables are read once where both ends of an edge are
wanted (no unions), and repeated edges go once a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``node, component`` (the smallest node of the component) for every node
    of the ``a, b`` edges. Self-loops and repeated edges do no harm."""
    ensure_checkpoint_dir(edges.sparkSession)
    # a star: every edge points from a node to a smaller one
    star = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            .where("u <> v").distinct().checkpoint())
    rounds = 0
    while not _settled(star):
        if rounds == max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        star = _small_star(_large_star(star)).checkpoint()
        rounds += 1
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _settled(star: DataFrame) -> bool:
    """Whether every node is either on top of others or hangs on just one."""
    ends = star.select(F.inline(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                        F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 or up > 0 and down > 0").isEmpty()


def _large_star(star: DataFrame) -> DataFrame:
    """Larger neighbours of each node point to the smallest of its neighbourhood
    (edges may come out repeated)."""
    both = star.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    larger = star.select(F.col("v").alias("u"), F.col("u").alias("larger"))
    return larger.join(least, "u").select(F.col("larger").alias("u"), F.col("m").alias("v"))


def _small_star(star: DataFrame) -> DataFrame:
    """A node and its smaller neighbours point to the smallest of them."""
    least = star.groupBy("u").agg(F.min("v").alias("m"))
    return (star.join(least, "u").select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))))
            .where("u <> v").distinct())
