"""Connected components of a link table: joined in tasks, then by alternating stars."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.batches import tidy
from tallystar.session import cut_lineage, few_files

JOINED = 1 << 19            # links that a task joins at once


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links and the smallest node each one reaches by them."""
    nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = at[:len(u)], at[len(u):]
    root = np.arange(len(nodes))
    while True:
        a, b = root[a], root[b]
        open_ = a != b
        if not open_.any():
            return nodes, nodes[root]
        a, b = np.maximum(a[open_], b[open_]), np.minimum(a[open_], b[open_])
        np.minimum.at(root, a, b)
        while (root[root] != root).any():
            root = root[root]


def joined(links: DataFrame) -> DataFrame:
    """(u, v) with the same components as ``links`` (u, v: long) and no more
    rows: each task replaces JOINED links at a time by links to their smallest
    nodes."""
    def run(batches):
        held, size = [], 0

        def fold():
            nodes, root = stars(*(np.concatenate([x[c].to_numpy() for x in held]) for c in "uv"))
            far = nodes != root
            return pd.DataFrame({"u": nodes[far], "v": root[far]})

        for pdf in batches:
            held.append(pdf)
            size += len(pdf)
            if size >= JOINED:
                yield fold()
                held, size = [], 0
        if size:
            yield fold()

    tasks = max(1, -(-links.count() // JOINED))
    return links.coalesce(tasks).mapInPandas(tidy(run), "u long, v long")


def _settled(edges: DataFrame) -> bool:
    """Whether every node is a root, or has one link, to a root."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("own")),
                                          F.struct(F.col("v").alias("node"), F.lit(0).alias("own")))).alias("e")).select("e.*")
    counts = ends.groupBy("node").agg(F.sum("own").alias("own"), F.count("*").alias("times"))
    return counts.where("own > 0 and times > 1").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long ids); root is the
    smallest node of the component.

    Tasks join the links they hold by themselves first, so links that fit one
    task (JOINED) are done then. Of more, large-star and small-star steps
    shrink all paths to stars in a logarithmic number of rounds. Each step is a
    map-side combined minimum and one join (a hub of many links is split by the
    skew join); every round is a written table, and only counts come to the
    driver.
    """
    edges = cut_lineage(joined(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))))
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        large = cut_lineage(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").where("u != v").distinct())
        edges = cut_lineage(small)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    both = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
    return cut_lineage(few_files(both, 2 * edges.count()))
