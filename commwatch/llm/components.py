"""Connected components of a graph given by its edges."""

from pyspark.sql import functions as F

from commwatch.llm.storage import stored


def components(edges):
    """One row ``(v, c)`` per end of an edge: ``c`` is the smallest end that edges lead to.

    ``edges`` has the whole-number columns ``a`` and ``b``. Repeated edges and loops do no harm; an
    empty table gives no rows. Each round takes the smallest label of the neighbours, then the
    label of one's own label, which halves the way to the smallest end. Labels are stored after
    each round; only the number of changes reaches the driver. Minima are taken before the
    shuffle, so an end with very many edges is a row per task.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct(), "edges")
    labels = stored(
        both.groupBy(F.col("a").alias("v")).agg(F.min(F.least("a", "b")).alias("c")), "labels"
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("v", "b"), "b")
            .groupBy(F.col("a").alias("v"))
            .agg(F.min("c").alias("n"))
        )
        lower = labels.join(near, "v").select(
            "v", F.least("c", "n").alias("c"), F.col("c").alias("old")
        )
        jump = labels.select(F.col("v").alias("c"), F.col("c").alias("j"))
        labels = stored(
            lower.join(jump, "c").select("v", F.least("c", "j").alias("c"), "old"), "labels"
        )
        if labels.where("c <> old").isEmpty():
            return labels.select("v", "c")
