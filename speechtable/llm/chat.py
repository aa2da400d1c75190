"""Chat formatting of reply trees, as DataFrame operations only.

``branches`` finds all root-to-leaf paths by iterative self-joins that double their reach: after k rounds a node knows its 2^k-th
ancestor, its distance and the score gathered on the way, so a thread of n replies takes log2(n) rounds of fixed-size rows and no
path is carried along. Leaves are ranked by the score of their path; only the nodes of chosen paths are
then picked up, going down the same doubling tables.

``conversations`` formats each chosen path as

    <|im_start|>role\\ncontent<|im_end|>\\n

A text cannot fake a mark: wherever ``<`` is followed by any number of backslashes and ``|``, one backslash is added; removing
one restores the text. In a role, ``%`` and newline are written %25 and %0A. The loss mask lists (start, length) in code points of the contents of the learned role.

Null texts and roles are empty; null scores count 0; a null tree id is a tree. Of rows with the same tree and node the least
(parent, role, text) stays. A parent that is not in the tree makes a root. Rows on or below a cycle have no root and form no path.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from speechtable import settings

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def branches(nodes: DataFrame, top: int = 1) -> DataFrame:
    """(tree, leaf, depth, node, role, text): the nodes of the ``top`` best paths of each tree, depth 1 at the root.

    ``nodes`` has tree, node, parent (null at a root), role, text, score. Paths are ranked by total score, then length, then leaf.
    """
    keyed = nodes.select(F.to_json(F.struct("tree")).alias("t"), "tree", "node", F.struct("parent", "role", "text", "score").alias("row"))
    keyed = settings.materialize(keyed.groupBy("t", "node").agg(F.min("tree").alias("tree"), F.min("row").alias("row")), "nodes")
    reach = keyed.select("t", "node", F.col("row.parent").alias("up"), F.lit(1).alias("depth"),
                         F.coalesce(F.col("row.score").cast("double"), F.lit(0.0)).alias("total"))
    # Rows that have met their root leave the rounds; the others join the last state of all rows.
    latest = settings.materialize(reach, "reach")
    n, open_rows = latest.agg(F.count("*"), F.count("up")).first()
    levels, done = [], []
    for _ in range(math.ceil(math.log2(max(n, 2))) + 1):
        done.append(latest.where("up IS NULL"))
        if not open_rows:
            break
        reach = latest.where("up IS NOT NULL")
        levels.append(reach)
        above = reduce(DataFrame.unionByName, [*done, reach]).select(
            "t", F.col("node").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"), F.col("total").alias("_total"))
        latest = settings.materialize(reach.join(above, ["t", "up"], "left").select(
            "t", "node", F.col("_up").alias("up"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
            (F.col("total") + F.coalesce("_total", F.lit(0.0))).alias("total")), "reach")
        open_rows = latest.agg(F.count("up")).first()[0]
    rooted = reduce(DataFrame.unionByName, done).drop("up")
    parents = keyed.select("t", F.col("row.parent").alias("node")).where("node IS NOT NULL").distinct()
    order = W.partitionBy("t").orderBy(F.desc("total"), F.desc("depth"), "node")
    leaves = rooted.join(parents, ["t", "node"], "left_anti").withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    chosen = leaves.select("t", F.col("node").alias("leaf"), "node")
    for level in reversed(levels):
        chosen = chosen.join(level.select("t", "node", "up"), ["t", "node"], "left").select(
            "t", "leaf", F.explode(F.array_compact(F.array("node", "up"))).alias("node"))
        # A jump past the root leaves the row as it is; no node is reached twice, as distances are distinct.
    placed = chosen.join(rooted.select("t", "node", "depth"), ["t", "node"]).join(keyed, ["t", "node"])
    return placed.select("t", "tree", "leaf", "depth", "node", "row.role", "row.text")


def conversations(paths: DataFrame, learned: str = "assistant") -> DataFrame:
    """(tree, leaf, formatted, mask): one row per path."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), _escape_role(role), F.lit("\n"))
    row = paths.select("t", "tree", "leaf", "depth", head.alias("head"), escape(text).alias("body"), (role == learned).alias("learn"))
    row = row.withColumn("size", F.length("head") + F.length("body") + len(END) + 1)
    before = W.partitionBy("t", "leaf").orderBy("depth").rowsBetween(W.unboundedPreceding, -1)
    row = row.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)) + F.length("head"))
    turn = F.struct("depth", F.concat("head", "body", F.lit(END + "\n")).alias("piece"),
                    F.when(F.col("learn"), F.struct(F.col("start").alias("start"), F.length("body").cast("long").alias("length"))).alias("span"))
    turns = row.groupBy("t", "leaf").agg(F.min("tree").alias("tree"), F.sort_array(F.collect_list(turn)).alias("turns"))
    return turns.select("tree", "leaf", F.array_join(F.col("turns.piece"), "").alias("formatted"), F.array_compact(F.col("turns.span")).alias("mask"))


def read_back(formatted: str = "formatted") -> Column:
    """Turns (role, text) of a formatted conversation."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>"), F.lit(2), F.size(F.split(formatted, r"<\|im_start\|>")))

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        body = F.substring(part, F.length(role) + 2, F.length(part) - F.length(role) - len(END) - 2)
        return F.struct(_unescape_role(role).alias("role"), unescape(body).alias("text"))

    return F.transform(parts, turn)


def under_mask(formatted: str = "formatted", mask: str = "mask") -> Column:
    """Unescaped text under the loss mask, one span after another."""
    return F.array_join(F.transform(mask, lambda s: unescape(F.substring(F.col(formatted), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
