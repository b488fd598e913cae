"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges(a long, b long); root is the smallest node reachable.

    Large star: each node hands its smallest neighbour (or itself) to its
    larger neighbours. Small star: each node hands the smallest of its smaller
    neighbours to the others and itself. Rounds go on until no edge changes,
    about log(nodes) of them. Smallest neighbours are partial aggregates, and
    the joins read written tables, so a node with very many edges is split.
    """
    cur = written(_directed(edges.select("a", "b")), "edges")
    state = _digest(cur)
    while state[0]:
        both = cur.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            cur.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = written(_directed(both.where("v > u").join(least, "u").select(
            F.col("v").alias("a"), F.col("m").alias("b"))), "large")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        cur = written(_directed(small.unionAll(least.select("a", F.col("m").alias("b")))), "small")
        before, state = state, _digest(cur)
        if state == before:
            break
    roots = cur.select(F.col("b").alias("node")).distinct()
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        roots.select("node", F.col("node").alias("root")))


def _directed(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _digest(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def label_components(items: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, root, label) of every item(node long, name); label is the smallest name in its component."""
    member = written(connected_components(edges), "members")
    least = member.join(items, "node").groupBy(F.col("root").alias("r")).agg(F.min("name").alias("least"))
    named = written(member.join(written(least, "least"), F.col("root") == F.col("r")).select(
        F.col("node").alias("m"), "root", "least"), "named")
    return written(items.join(named, F.col("node") == F.col("m"), "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.coalesce("least", "name").alias("label")), "labels")


def star_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between numbered rows, cut down to one link of each row to its group's smallest row."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]
