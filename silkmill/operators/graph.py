"""A property graph as two tables: every change gives new tables, nothing is updated in place.

Nodes: labels array<string>, id bigint, name string, props map<string,string>.
Edges: id bigint, source bigint, target bigint, label string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def max_node_id(nodes: DataFrame) -> DataFrame:
    """One row: max_id, -1 for an empty graph."""
    return nodes.agg(F.coalesce(F.max("id"), F.lit(-1)).cast("long").alias("max_id"))


def merge_props(old: Column, new: Column) -> Column:
    """Properties of both, the new value where both have one."""
    none = F.expr("map()").cast("map<string,string>")
    old, new = F.coalesce(old, none), F.coalesce(new, none)
    kept = F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k))
    return F.map_concat(kept, new)


def upsert_nodes(nodes: DataFrame, changes: DataFrame) -> DataFrame:
    """Nodes with ``changes`` (unique by labels and id): given names and properties overwrite, others stay; new ones are added."""
    old = nodes.select("labels", "id", F.col("name").alias("_n"), F.col("props").alias("_p"), F.lit(True).alias("_old"))
    both = old.join(changes, ["labels", "id"], "full_outer")
    return both.select("labels", "id", F.coalesce("name", "_n").alias("name"), merge_props(F.col("_p"), F.col("props")).alias("props"), F.col("_old").isNull().alias("inserted"))


def update_nodes(nodes: DataFrame, changes: DataFrame) -> DataFrame:
    """Nodes with the names and properties of ``changes`` (unique by id, given values overwrite) and ``changed``; ids that
    no node has change nothing and add nothing, see ``unmatched``."""
    new = changes.select("id", F.col("name").alias("_n"), F.col("props").alias("_p"), F.lit(True).alias("_new"))
    joined = nodes.join(new, "id", "left")
    changed = F.col("_new").isNotNull()
    props = F.when(changed, merge_props(F.col("props"), F.col("_p"))).otherwise(F.col("props"))
    return joined.select("labels", "id", F.coalesce("_n", "name").alias("name"), props.alias("props"), changed.alias("changed"))


def unmatched(nodes: DataFrame, changes: DataFrame) -> DataFrame:
    """The ids of ``changes`` that no node has."""
    return changes.select("id").distinct().join(nodes.select("id"), "id", "left_anti")


def find_nodes(nodes: DataFrame, label: str, props: dict[str, str], n: int = 1) -> DataFrame:
    """The first ``n`` nodes by id that have a label and all properties."""
    hit = F.array_contains("labels", label)
    for k, v in props.items():
        hit = hit & (F.element_at("props", k) == v)
    return nodes.where(hit).orderBy("id").limit(n)


def delete_nodes(nodes: DataFrame, label: str, ids: DataFrame) -> DataFrame:
    """Nodes without those of a label whose id is in ``ids``."""
    gone = ids.select("id").distinct().withColumn("_gone", F.lit(True))
    return nodes.join(gone, "id", "left").where(F.col("_gone").isNull() | ~F.array_contains("labels", label)).drop("_gone")


def delete_label(nodes: DataFrame, edges: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) without the nodes of a label and the edges at them."""
    gone = nodes.where(F.array_contains("labels", label)).select("id").distinct()
    left = edges.join(gone.withColumnRenamed("id", "source"), "source", "left_anti").join(gone.withColumnRenamed("id", "target"), "target", "left_anti")
    return nodes.where(~F.array_contains("labels", label)), left


def delete_all(nodes: DataFrame, edges: DataFrame, most: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) without the first ``most`` nodes by id and the edges at them."""
    gone = nodes.orderBy("id").limit(most).select("id")
    left = edges.join(gone.withColumnRenamed("id", "source"), "source", "left_anti").join(gone.withColumnRenamed("id", "target"), "target", "left_anti")
    return nodes.join(gone, "id", "left_anti"), left


def replace_edges(edges: DataFrame, new: DataFrame, either_way: bool = False) -> DataFrame:
    """Edges with every one between the pairs of ``new`` removed, of any label, and ``new`` added."""
    pairs = new.select("source", "target").distinct()
    if either_way:
        pairs = pairs.unionByName(pairs.select(F.col("target").alias("source"), F.col("source").alias("target"))).distinct()
    return edges.join(pairs, ["source", "target"], "left_anti").unionByName(new)


def incident_edges(edges: DataFrame, ids: DataFrame, direction: str = "out") -> DataFrame:
    """Edges at a set of nodes, each once: going "out" of them, coming "in", or "both"."""
    ids = ids.select("id").distinct()
    out = edges.join(ids.withColumnRenamed("id", "source"), "source", "left_semi")
    into = edges.join(ids.withColumnRenamed("id", "target"), "target", "left_semi")
    return {"out": out, "in": into}[direction] if direction != "both" else out.unionByName(into).dropDuplicates(["id"])


def tree_edges(tree: DataFrame, compat: bool = False) -> DataFrame:
    """(parent, child) of a tree's nodes (id, parent): id -1 is no node; parents -1 and -2 are none, with ``compat`` only -1."""
    none = [-1] if compat else [-1, -2]
    return tree.where((F.col("id") != -1) & ~F.col("parent").isin(none)).select("parent", F.col("id").alias("child"))


def dot_lines(tree: DataFrame, caption: Column, compat: bool = False) -> DataFrame:
    """(line_no, line): the tree in the DOT language, nodes before edges, both by id."""
    quoted = F.replace(F.replace(caption, F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    nodes = tree.where(F.col("id") != -1).select(F.lit(0).alias("kind"), F.col("id").alias("a"), F.lit(0).alias("b"), F.concat(F.col("id").cast("string"), F.lit(' [label="'), quoted, F.lit('"]')).alias("line"))
    edges = tree_edges(tree, compat).select(F.lit(1).alias("kind"), F.col("parent").alias("a"), F.col("child").alias("b"), F.concat(F.col("parent").cast("string"), F.lit(" -> "), F.col("child").cast("string")).alias("line"))
    # a drawing is small by nature: one ordered list
    w = Window.partitionBy(F.lit(0)).orderBy("kind", "a", "b")
    return nodes.unionByName(edges).select(F.row_number().over(w).alias("line_no"), "line")
