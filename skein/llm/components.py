"""Connected components of an edge table: smallest member as the label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``label``) for every end of ``edges`` (``a``, ``b``), label the smallest node reachable.

    Alternates hooking (a label takes the smallest label that an edge of its members shows)
    and pointer doubling, so long chains take about log rounds. A round is two grouped minima,
    combined on the map side, and two equi-joins; labels are rewritten to the shared folder.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    now = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        # the smallest label next to each label's members
        seen = both.join(now, both["a"] == now["node"]).select("b", F.col("label").alias("from"))
        offers = seen.groupBy("b").agg(F.min("from").alias("offer"))
        met = now.join(offers, now["node"] == offers["b"]).select("label", "offer")
        hooks = met.groupBy(F.col("label").alias("old")).agg(F.min("offer").alias("offer"))
        hooked = now.join(hooks, now["label"] == hooks["old"]).select("node", F.least("label", "offer").alias("label"))
        hooked = stored(hooked, "labels")
        up = hooked.select(F.col("node").alias("label"), F.col("label").alias("top"))
        new = stored(hooked.join(up, "label").select("node", F.least("label", "top").alias("label")), "labels")
        same = new.join(now.withColumnRenamed("label", "was"), "node").where("label <> was").limit(1).count() == 0
        discard(hooked)
        discard(now)
        now = new
        if same:
            discard(both)
            return now
