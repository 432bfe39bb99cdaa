"""Connected components of a table of links, in Spark rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from odsflow.llm.store import settle
from odsflow.sizing import is_small

#: Bytes of links up to which labels are broadcast rather than shuffled.
LINKS_BROADCAST = 16 << 20


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes in ``links`` (a, b); the label is a component's least node.

    A round gives each node the least label among its neighbours and then that
    label's own label, so the labels of a chain travel in doubling steps. Rounds
    end when no label has changed. Labels are fewer than links, so links that
    measure small let both joins of a round broadcast; its one aggregate is then
    the only shuffle.
    """
    # A link given twice does no harm: only least labels are taken.
    both = settle(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).where("a <> b"), "links")
    placed = F.broadcast if is_small(both, LINKS_BROADCAST) else (lambda df: df)
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
    labels = settle(labels.select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        near = both.join(placed(labels.withColumnRenamed("node", "b")), "b")
        seen = labels.select("node", F.col("label").alias("_old"), "label").union(
            near.select("a", F.lit(None).cast("long"), "label")
        )
        hooked = seen.groupBy("node").agg(F.max("_old").alias("_old"), F.min("label").alias("_new"))
        own = labels.select(F.col("node").alias("_at"), F.col("label").alias("_far"))
        jumped = hooked.join(placed(own), F.col("_new") == F.col("_at"), "left").select(
            "node", "_old", F.least(F.col("_new"), F.coalesce("_far", "_new")).alias("label")
        )
        jumped = settle(jumped, "labels")
        changed = jumped.where("_old <> label").limit(1).count()
        labels = jumped.select("node", "label")
        if not changed:
            return labels
