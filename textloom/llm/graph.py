"""Connected components by repeated contraction, all on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm import maps
from textloom.llm._common import materialize, pieces
from textloom.llm.maps import hot_map, joined

#: Nodes, and bytes of their values, of one root that a task compares at once; more are dealt to pairs of blocks.
MOST, MOST_BYTES = 1 << 9, 1 << 22
SALTS = 16


def stars(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what these pairs do, each to the least of its component."""
    nodes, ends = np.unique(np.r_[x, y], return_inverse=True)
    root = np.arange(len(nodes))
    a, b = ends[: len(x)], ends[len(x) :]
    while True:
        least = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], least)
        np.minimum.at(root, root[b], least)
        root = root[root]
        if (root == before).all():
            return nodes[root], nodes


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the links (a, b); nodes of one component have one root.

    In a round each node takes that one of itself and its neighbours which comes first, in the first round
    by its number (stars around least nodes are done by that), then by a hash drawn anew for the round, and
    links are carried over to what was taken. The nodes still linked shrink by a constant factor, so rounds
    grow with the logarithm of the longest path. Minima are taken before the shuffle, so a node with very
    many links is no hot spot. Nothing is broadcast, so the driver's memory does not depend on the links.
    """
    links = materialize(edges.select("a", "b").where(F.col("a") != F.col("b")).distinct())
    taken: list[DataFrame] = []
    while not links.isEmpty():
        order = lambda c: F.xxhash64(F.col(c), F.lit(len(taken))) if taken else F.col(c)  # noqa: B023, E731
        ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other"))))
        best = links.select(ends.alias("e")).select("e.*").groupBy("node").agg(F.min(F.struct(order("other").alias("h"), F.col("other"))).alias("best"), F.count("*").alias("degree"))
        took = materialize(best.select("node", F.when(F.struct(order("node").alias("h"), F.col("node").alias("other")) < F.col("best"), F.col("node")).otherwise(F.col("best.other")).alias("took"), "degree"))
        hubs = hot_map(took.where(F.col("degree") > maps.HOT_ROWS), "node")
        moved = joined(links, took.select(F.col("node").alias("a"), F.col("took").alias("ta")), ["a"], hubs, "a", F.xxhash64("b"))
        moved = joined(moved, took.select(F.col("node").alias("b"), F.col("took").alias("tb")), ["b"], hubs, "b", F.xxhash64("a"))
        links = materialize(moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).where("a <> b").distinct())
        taken.append(took)
    if not taken:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))

    # From the last round, which has the fewest nodes, back to the first, which has all; each in a plan of its own, so that the driver's plans do not grow with the rounds.
    found = taken.pop().select("node", F.col("took").alias("root"))
    while taken:
        step = taken.pop()
        hubs = hot_map(step.groupBy("took").count().where(F.col("count") > maps.HOT_ROWS), "took")
        later = found.select(F.col("node").alias("took"), "root")
        found = materialize(joined(step, later, ["took"], hubs, "took", F.xxhash64("node"), "left").select("node", F.coalesce("root", "took").alias("root")))
    return found


def named(nodes: DataFrame, roots: DataFrame, node: str, least: Column) -> DataFrame:
    """(node, component_id) of all nodes: the minimum of ``least`` over the nodes of one root; nodes without a root are alone."""
    rooted = nodes.join(roots.select(F.col("node").alias(node), "root").hint("merge"), node, "left").select(node, least.alias("least"), F.coalesce("root", node).alias("root"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("n"))
    large = hot_map(roots.groupBy("root").count().where(F.col("count") > maps.HOT_ROWS), "root")
    return joined(rooted.select(node, "root"), names.select("root", "component_id"), ["root"], large, "root", F.xxhash64(node)).select(node, "component_id")


def within(members: DataFrame, values: DataFrame, prepare: Callable[[pa.Array], list], search: Callable[[list], tuple[np.ndarray, np.ndarray]], most: int | None = None) -> DataFrame:
    """Links (a, b) that ``search`` finds among the prepared values (node, value) of each root's members (root, node, size).

    Every two nodes of a root are given to one call, so search may return only what connects the same nodes.
    A root with many members is a key of SALTS tasks where it meets its number of blocks.
    """
    most = most or MOST
    counts = members.groupBy("root").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes")).where("rows > 1")
    n = F.ceil(F.greatest(F.col("rows") / most, F.col("bytes") / MOST_BYTES)).cast("long")
    salted = counts.select("root", n.alias("n"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    mine = members.select("root", "node", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int").alias("salt"))
    mine = mine.join(salted.hint("merge"), ["root", "salt"]).withColumn("mine", F.pmod(F.xxhash64("node", F.lit("block")), "n"))
    others = F.when(F.col("n") == 1, F.array("mine")).otherwise(F.filter(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda x: x != F.col("mine")))
    keyed = mine.withColumn("other", F.explode(others)).select(F.xxhash64("root", F.least("mine", "other"), F.greatest("mine", "other")).alias("k"), "node")
    met = keyed.join(values.hint("merge"), "node").select("k", "node", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, values = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            if len(nodes) > 1:
                x, y = search(values)
                at = np.array(nodes, np.int64)
                if len(x):
                    x, y = stars(at[x], at[y])
                    yield pa.RecordBatch.from_arrays([pa.array(x[x != y]), pa.array(y[x != y])], ["a", "b"])

        for batch in pieces(batches):
            for k, node, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), prepare(batch.column(2))):
                if k != key:
                    yield from close()
                    key, nodes, values = k, [], []
                nodes.append(node)
                values.append(value)
        yield from close()

    # A given number of partitions: few bytes may take long to compare, so they are not put together by size.
    dealt = met.repartition(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), "k").sortWithinPartitions("k")
    return dealt.mapInArrow(run, "a long, b long")
