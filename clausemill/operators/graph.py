"""Walks over clauses and references.

Walks to a fixed point go round by round: a round reads the tables that earlier rounds wrote and writes its own, so the plan of a round
is the same however many there are, and a lost executor costs no more than its tasks of one round.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import delete_folder, shared_folder, written


def ancestors(clauses: DataFrame, deepest: int = 3) -> DataFrame:
    """(clause_id, ancestor_id, depth), each clause its own ancestor at depth 0.

    The hierarchy has ``deepest`` levels, so the walk is that many joins on the parent.
    """
    up = clauses.select(F.col("clause_id").alias("at"), F.col("parent_id").alias("next"))
    step = clauses.select("clause_id", F.col("clause_id").alias("ancestor_id"), F.col("parent_id").alias("above"), F.lit(0).alias("depth"))
    out = step
    for depth in range(1, deepest):
        step = step.where("above IS NOT NULL").join(up, F.col("above") == F.col("at")).select("clause_id", F.col("above").alias("ancestor_id"), F.col("next").alias("above"), F.lit(depth).alias("depth"))
        out = out.unionByName(step)
    return out.select("clause_id", "ancestor_id", "depth")


def reachable(references: DataFrame, starts: DataFrame, hops: int = 3) -> DataFrame:
    """(start_id, clause_id, hops): clauses that references lead to, by the fewest hops; cycles end as nothing new is found."""
    edges = references.where("dst_clause_id IS NOT NULL").select(F.col("src_clause_id").alias("src"), F.col("dst_clause_id").alias("dst")).distinct()
    seen = starts.select(F.col("clause_id").alias("start_id"), "clause_id", F.lit(0).alias("hops")).distinct()
    front = seen
    for hop in range(1, hops + 1):
        met = front.join(edges, F.col("clause_id") == F.col("src")).select("start_id", F.col("dst").alias("clause_id")).distinct()
        front = met.join(seen, ["start_id", "clause_id"], "left_anti").withColumn("hops", F.lit(hop))
        seen = seen.unionByName(front)
    return seen


class _Rounds:
    """Tables of rounds under one folder, which goes once the result is written elsewhere."""

    def __init__(self, df: DataFrame):
        self.spark, self.root = df.sparkSession, f"{shared_folder(df.sparkSession)}/rounds-{uuid.uuid4().hex}"

    def put(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.root}/{name}")

    def all(self, names: list[str], schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{n}" for n in names])

    def drop(self, *names: str) -> None:
        for name in names:
            delete_folder(self.spark, f"{self.root}/{name}")

    def end(self) -> None:
        delete_folder(self.spark, self.root)


def _edges(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Both ends, known ones, each pair once, as longs."""
    return edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.col(src).cast("long").alias("src"), F.col(dst).cast("long").alias("dst")).distinct()


def traversed(references: DataFrame, clauses: DataFrame) -> DataFrame:
    """The edges of a traversal: a clause leads to what it refers to and to the clauses below it."""
    below = clauses.where("parent_id IS NOT NULL").select(F.col("parent_id").alias("src_clause_id"), F.col("clause_id").alias("dst_clause_id"))
    return references.where("dst_clause_id IS NOT NULL").select("src_clause_id", "dst_clause_id").union(below)


def closure(edges: DataFrame, starts: DataFrame, src: str = "src_clause_id", dst: str = "dst_clause_id", start: str = "clause_id") -> DataFrame:
    """(start_id, node_id, hops, path): all that edges lead to from each start, however far, by a shortest path.

    ``path`` has the nodes from the start to the node; of several shortest ones it is the first in order of their ids. A start reaches itself
    in 0 hops. Cycles end as nothing new is found; rounds are as many as the longest of the shortest paths. Semi-naive: a round
    follows the edges from what the last one found, and keeps what no round has. Null ends and starts are left out, repeated edges and starts count once.
    """
    rounds = _Rounds(edges)
    hop = rounds.put(_edges(edges, src, dst), "edges")
    first = starts.where(F.col(start).isNotNull()).select(F.col(start).cast("long").alias("start_id")).distinct()
    front = rounds.put(first.select("start_id", F.col("start_id").alias("node_id"), F.lit(0).alias("hops"), F.array("start_id").alias("path")), "front-0")
    names, k = ["front-0"], 0
    while not front.isEmpty():
        k += 1
        met = front.join(hop, F.col("node_id") == F.col("src")).groupBy("start_id", F.col("dst").alias("node_id")).agg(F.min("path").alias("above"))
        new = met.join(rounds.all(names, front.schema).select("start_id", "node_id"), ["start_id", "node_id"], "left_anti")
        front = rounds.put(new.select("start_id", "node_id", F.lit(k).alias("hops"), F.concat("above", F.array("node_id")).alias("path")), f"front-{k}")
        names.append(f"front-{k}")
    out = written(rounds.all(names, front.schema), "closure")
    rounds.end()
    return out


def _reached(rounds: _Rounds, hop: DataFrame, seeds: DataFrame, tag: str) -> DataFrame:
    """seeds (node, color) -> node, color: the highest color that reaches each node along edges between nodes that are in ``hop``."""
    now = rounds.put(seeds, f"{tag}-0")
    front, k = now, 0
    while not front.isEmpty():
        k += 1
        told = front.join(hop, F.col("node") == F.col("src")).groupBy(F.col("dst").alias("n")).agg(F.max("color").alias("c"))
        changed = rounds.put(now.join(told, F.col("node") == F.col("n")).where(F.col("c") > F.col("color")).select("node", F.col("c").alias("color")), f"{tag}-new-{k}")
        better = changed.select(F.col("node").alias("n"), F.col("color").alias("c"))
        later = rounds.put(now.join(better, F.col("node") == F.col("n"), "left").select("node", F.coalesce("c", "color").alias("color")), f"{tag}-{k}")
        rounds.drop(f"{tag}-{k - 1}", f"{tag}-new-{k - 1}")
        now, front = later, changed
    return now


def cycles(edges: DataFrame, src: str = "src_clause_id", dst: str = "dst_clause_id") -> DataFrame:
    """(node_id, component_id, size): nodes that lie on a cycle, by strongly connected component, named by its least node.

    Nodes without an edge in or out are on none and go first, again and again. Then every node takes the highest node that
    reaches it as its color; a color's own node and what leads back to it within the color are a component, which goes, and so on with the
    rest until there is none. An edge of a node to itself makes a cycle of one.
    """
    rounds = _Rounds(edges)
    all_ = rounds.put(_edges(edges, src, dst), "edges")
    loops = all_.where("src = dst").select(F.col("src").alias("node_id")).distinct()
    hop, k = rounds.put(all_.where("src <> dst"), "hop-0"), 0
    schema, found = hop.sparkSession.createDataFrame([], "node_id long, color long").schema, []
    while not hop.isEmpty():
        k += 1
        # Only nodes with edges both in and out can be on a cycle: trim until none goes.
        size = hop.count()
        while True:
            ins, outs = hop.select(F.col("dst").alias("n")).distinct(), hop.select(F.col("src").alias("n")).distinct()
            inner = ins.join(outs, "n", "left_semi")
            kept = hop.join(inner.select(F.col("n").alias("src")), "src", "left_semi").join(inner.select(F.col("n").alias("dst")), "dst", "left_semi")
            hop = rounds.put(kept.select("src", "dst"), f"trim-{k}-{size}")
            left = hop.count()
            if left == size:
                break
            size = left
        if not size:
            break
        nodes = hop.select(F.col("src").alias("node")).union(hop.select(F.col("dst").alias("node"))).distinct()
        colored = rounds.put(_reached(rounds, hop, nodes.withColumn("color", F.col("node")), f"color-{k}"), f"colored-{k}")
        a, b = (colored.select(F.col("node").alias(end), F.col("color").alias(f"{end}_color")) for end in ("src", "dst"))
        within = rounds.put(hop.join(a, "src").join(b, "dst").where("src_color = dst_color").select("src", "dst", F.col("src_color").alias("color")), f"within-{k}")
        # Backwards from the color's own node, within the color.
        front = rounds.put(colored.where("node = color"), f"back-{k}-0")
        names, step = [f"back-{k}-0"], 0
        while not front.isEmpty():
            step += 1
            met = front.select(F.col("node").alias("dst")).join(within, "dst").select(F.col("src").alias("node"), "color").distinct()
            new = met.join(rounds.all(names, front.schema).select("node"), "node", "left_anti")
            front = rounds.put(new, f"back-{k}-{step}")
            names.append(f"back-{k}-{step}")
        done = rounds.put(rounds.all(names, front.schema).select(F.col("node").alias("node_id"), "color"), f"found-{k}")
        found.append(f"found-{k}")
        gone = done.select(F.col("node_id").alias("n"))
        rest = hop.join(gone, F.col("src") == F.col("n"), "left_anti").join(gone, F.col("dst") == F.col("n"), "left_anti")
        hop = rounds.put(rest, f"hop-{k}")
    parts = rounds.all(found, schema) if found else hop.sparkSession.createDataFrame([], schema)
    named = parts.groupBy("color").agg(F.min("node_id").alias("component_id"), F.count(F.lit(1)).alias("size"))
    several = parts.join(named.where("size > 1"), "color").select("node_id", "component_id", "size")
    alone = loops.join(several, "node_id", "left_anti").select("node_id", F.col("node_id").alias("component_id"), F.lit(1).cast("long").alias("size"))
    out = written(several.unionByName(alone), "cycles")
    rounds.end()
    return out


def external_documents(references: DataFrame, documents: DataFrame) -> DataFrame:
    """References with target_document_id: the document whose title the target names; nothing is fetched."""
    titles = documents.where("title IS NOT NULL").groupBy(F.col("title").alias("t")).agg(F.min("document_id").alias("found"))
    joined = references.join(titles, F.col("target_citation") == F.col("t"), "left")
    return joined.withColumn("target_document_id", F.coalesce("target_document_id", "found")).drop("t", "found")


def corrected(pages: DataFrame, errata: DataFrame) -> DataFrame:
    """pages (document_id, page_ordinal, raw_text) with the errata's text where there is one."""
    fixes = errata.select("document_id", "page_ordinal", F.col("raw_text").alias("fixed"))
    return pages.join(fixes, ["document_id", "page_ordinal"], "left").withColumn("raw_text", F.coalesce("fixed", "raw_text")).drop("fixed")
