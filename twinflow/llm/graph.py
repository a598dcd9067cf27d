"""Connected components of an undirected graph, smallest vertex first."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinflow.llm.common import Scratch


def _ends(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """``edges`` between the labels of their ends, each once; those inside of a label go. A vertex without a label is its own."""
    for end in ("a", "b"):
        edges = edges.join(labels.select("v", "component"), F.col(end) == F.col("v"), "left").withColumn(end, F.coalesce("component", end)).drop("v", "component")
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _through(labels: DataFrame, further: DataFrame) -> DataFrame:
    """``labels``, those that ``further`` labels by its labels; ``moved`` tells which."""
    further = further.select(F.col("v").alias("j"), F.col("component").alias("root"))
    label = F.coalesce("root", "component")
    return labels.join(further, F.col("component") == F.col("j"), "left").select("v", label.alias("component"), (label < F.col("component")).alias("moved"))


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``v, component`` (and more) for every vertex of ``edges`` (``a, b``, longs).

    Every vertex takes the smallest one around it, then the label of its label until none changes. Edges between
    labels are the next round's graph, the others are done, so an edge is not read in every round. A vertex of a round takes a
    smaller one or gives its label to another one in this round or the next, so rounds grow with the logarithm of the vertices.
    Each step is written to the shared folder, so a lost executor costs a re-read. No edges: empty.
    """
    scratch = scratch or Scratch(edges.sparkSession)
    edges = edges.where("a is not null and b is not null")
    left = scratch.keep(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while True:
        both = left.select("a", "b").union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = scratch.keep(both.groupBy(F.col("a").alias("v")).agg(F.min(F.least("a", "b")).alias("component")), "labels")
        while True:
            before, near = near, scratch.keep(_through(near, near), "labels")
            scratch.free(before)
            if near.where("moved").isEmpty():
                break
        done, left = left, scratch.keep(_ends(left, near), "edges")
        if labels is None:
            labels = near
        else:
            before, labels = labels, scratch.keep(_through(labels, near), "labels")
            scratch.free(before, near)
        scratch.free(done)
        if left.isEmpty():
            scratch.free(left)
            return labels


def joined(known: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """The components of a graph of which ``known`` has those so far, and of further ``edges``; only what these join is worked on."""
    more = components(_ends(edges, known), scratch)
    new = more.join(known.select("v"), "v", "left_anti").select("v", "component", F.lit(True).alias("moved"))
    labels = scratch.keep(_through(known, more).union(new), "labels")
    scratch.free(more)
    return labels
