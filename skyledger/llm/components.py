"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from skyledger.llm.common import materialize


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Links the neighbours of each node to the smallest of them and itself.

    ``edges`` point from ``u`` to a smaller ``v``. The large star links the larger
    neighbours, the small star the smaller ones and the node itself.
    """
    if larger_only:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        larger = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        linked = larger.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
        linked = edges.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        linked = linked.unionByName(smallest.select("u", F.col("m").alias("v")))
    return linked.filter(F.col("u") > F.col("v")).distinct()


def _mark(edges: DataFrame) -> Row:
    link = F.xxhash64("u", "v")
    return edges.agg(F.count("*"), F.bit_xor(link), F.sum(F.shiftright(link, 20))).first()


def connected(edges: DataFrame) -> DataFrame:
    """Columns ``node`` and ``root`` for every node of ``edges`` (``a``, ``b``, both long).

    ``root`` is the smallest node of the component. Large and small stars take
    turns until nothing changes; every round is written to the shared folder. The
    driver sees three numbers a round. Loops, repeated edges and edges with a NULL
    end count for nothing; a node without another neighbour has no row.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter(
        F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))
    )
    links = materialize(links.distinct(), "links")
    mark = _mark(links)
    while mark[0]:
        links = materialize(_star(_star(links, True), False), "links")
        before, mark = mark, _mark(links)
        if before == mark:
            break
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
