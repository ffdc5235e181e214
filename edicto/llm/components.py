"""Connected components of an undirected link table, as DataFrame steps.

Labels spread along links and are then shortened (a label takes the label of
its own node), so a path of length n needs about log n rounds.  Each round is
written to the shared folder; only counts reach the driver.  Links of a hub
are reduced before the shuffle by the map-side minimum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edicto.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """`node, comp` for every node of `a, b`; `comp` is its component's least node."""
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .filter("a IS NOT NULL AND b IS NOT NULL").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        spread = labels.join(near, "node").select("node", F.least("comp", "near").alias("comp"), F.col("comp").alias("was"))
        own = labels.select(F.col("node").alias("comp"), F.col("comp").alias("short"))
        new = written(spread.join(own, "comp").select("node", F.least("comp", "short").alias("comp"), "was"), "labels")
        if new.filter("comp <> was").isEmpty():
            return new.select("node", "comp")
        labels = new.select("node", "comp")
