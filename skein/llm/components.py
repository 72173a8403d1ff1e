"""Connected components of a link table that no single machine needs to hold."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.common import materialize

MAX_ROUNDS = 100


def merge_links(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Union the ends of links in ``label`` (node -> smallest known node of its
    group), in place; for the links found inside one task."""
    while True:
        a, b = label[x], label[y]
        open_ = a != b
        if not open_.any():
            return
        x, y, a, b = x[open_], y[open_], a[open_], b[open_]
        least = np.minimum(a, b)
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label[:] = jumped


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (two long columns a, b);
    the component is its smallest node. Alternates large-star and small-star
    steps; each is an aggregate by node, written so that the join back to the
    links is between two plain tables and a node with very many links can be
    split by Spark. Links shrink towards one per node; rounds are logarithmic."""
    a, b = F.col("a"), F.col("b")
    links = materialize(links.where(a != b).select(F.greatest(a, b).alias("a"),
                                                   F.least(a, b).alias("b")).distinct(), "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return links.select(a.alias("node"), b.alias("component")).union(
                links.select(b, b)).distinct()
        seen = state
        both = materialize(links.union(links.select("b", "a")), "both-ways")
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m"))
                            .select(F.col("a").alias("u"), F.least("a", "m").alias("m")), "least")
        links = materialize(
            both.join(least, both.a == least.u).where("b > a").select(b.alias("a"), F.col("m").alias("b"))
            .where(a != b).distinct(), "large-star")
        least = materialize(links.groupBy("a").agg(F.min("b").alias("m"))
                            .select(F.col("a").alias("u"), "m"), "least")
        met = links.join(least, links.a == least.u)
        parts = [met.select(a, F.col("m").alias("b")),
                 met.where("b != m").select(b.alias("a"), F.col("m").alias("b"))]
        links = materialize(reduce(DataFrame.union, parts).distinct(), "small-star")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
