"""Manifest of a dataset: a Merkle tree per group of rows, and one over the groups, with proofs for every row.

Nodes are labelled with the interval of leaf ranks they cover, ``[lo, hi)``. At level k a node covers at most ``FAN``**k
ranks, and ``lo div FAN**k`` is its bucket there.

1. Leaves get dense ranks within their tree. Spark sorts them by ranges; rows of one tree and one partition are consecutive,
   so a rank is the place in the partition plus the number of earlier rows, known from one row per partition and tree.
2. Level by level, nodes whose intervals lie in the same bucket of the next level become children of one parent: at most
   ``FAN`` rows each, however many rows a tree has. A tree ends with the level at which one node covers all of it.
3. From the top down, nodes are joined with the parent of the level above that contains them: same tree, same bucket, and
   interval inside interval. The parent brings the path of its own ancestors along. What its children cover outside the
   node's interval are the siblings: those that end before it on the left, those that begin after it on the right.
   Each level is an eighth of the one below, and leaves take their path from the row of their parent.

The roots of the trees are the leaves of a tree of their own, built the same way, so the number of trees may be any.

A NULL group is a tree like others and comes first. Rows are ordered by their key, NULL first, then by their
digest; rows alike in both count as often as they occur. NULL cells have an encoding of their own. An empty table has
no rows. Other columns are neither hashed nor returned.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.sources.scratch import Stored, materialize

FAN = 8
_IN_PARTITION = (1 << 33) - 1
_PATH = "array<struct<before: string, behind: string>>"


def cell(value: Column) -> Column:
    """A value with its length in bytes before it, so that no two rows run together; NULL is a hyphen."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way lead to."""
    return F.aggregate(path, start, lambda own, step: digest(step["before"], own, step["behind"]))


def siblings(path: Column) -> Column:
    """All siblings of a path, level by level, left to right."""
    return F.concat_ws("", F.transform(path, lambda step: F.concat(step["before"], step["behind"])))


def _ranked(leaves: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    """Add ``rank``, dense from 0 within each ``tree``, and ``total``, the number of rows of the tree."""
    spark = leaves.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(leaves, f"{label}-leaves").df.withColumn("__place", F.monotonically_increasing_id())
    total = [F.asc_nulls_first("tree"), *order, F.asc("__place")]  # the place spreads rows alike in everything
    ordered = placed.repartitionByRange(tasks, *total).sortWithinPartitions(*total).drop("__place")
    row = F.monotonically_increasing_id()
    numbered = ordered.select("*", F.shiftright(row, 33).cast("int").alias("__part"), row.bitwiseAND(_IN_PARTITION).alias("__row"))
    stored = materialize(numbered, f"{label}-sorted").df
    parts = stored.groupBy("tree", "__part").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__size"))
    own = Window.partitionBy("tree")
    before = F.coalesce(F.sum("__size").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    known = parts.select(
        F.col("tree").alias("__tree"), F.col("__part").alias("__in"), (before - F.col("__first")).alias("__shift"), F.sum("__size").over(own).alias("total")
    )
    same = F.col("tree").eqNullSafe(F.col("__tree")) & (F.col("__part") == F.col("__in"))
    return stored.join(known, same).withColumn("rank", F.col("__row") + F.col("__shift")).drop("__tree", "__in", "__shift", "__part", "__row")


def _parents(nodes: DataFrame, level: int, extra: Sequence[str] = ()) -> DataFrame:
    """The nodes of ``level`` from those below: at most ``FAN`` children share the bucket ``lo div FAN**level``."""
    child = F.struct("lo", "hi", "digest", *extra)
    bucket = F.expr(f"lo div {FAN**level}").alias("bucket")
    grouped = nodes.groupBy("tree", "total", bucket).agg(F.array_sort(F.collect_list(child)).alias("children"))
    return grouped.select(
        "tree",
        "total",
        "children.lo",
        F.col("children.hi").alias("__hi"),
        F.sha2(F.concat_ws("", "children.digest"), 256).alias("digest"),
        "children",
    ).select("tree", "total", F.col("lo")[0].alias("lo"), F.element_at("__hi", -1).alias("hi"), "digest", "children")


def build(leaves: DataFrame, extra: Sequence[str], label: str) -> tuple[list[Stored], DataFrame]:
    """The levels of all trees, from 1 upwards, and the top node of each tree (``tree``, ``digest``, ``total``).

    ``leaves`` has ``tree``, ``rank``, ``total``, ``digest`` and the columns ``extra``, which level 1 keeps with its children.
    """
    nodes = leaves.select("tree", "total", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest", *extra)
    levels: list[Stored] = []
    while True:
        levels.append(materialize(_parents(nodes, len(levels) + 1, extra if not levels else ()), f"{label}-level"))
        nodes = levels[-1].df.filter(F.col("hi") - F.col("lo") < F.col("total")).drop("children")
        if nodes.isEmpty():
            break
    # a tree of one leaf is that leaf: its only parent is no node of the tree
    alone = F.when(F.col("total") == 1, F.col("children")[0]["digest"]).otherwise(F.col("digest"))
    tops = [stored.df.filter(F.col("hi") - F.col("lo") == F.col("total")).select("tree", alone.alias("digest"), "total") for stored in levels]
    top = tops[0]
    for other in tops[1:]:
        top = top.unionByName(other)
    return levels, top


def _step(children: Column, node: Column) -> Column:
    """The siblings of a node: what the children of its parent cover outside its interval."""
    side = lambda inside: F.concat_ws("", F.transform(F.filter(children, inside), lambda c: c["digest"]))
    return F.struct(side(lambda c: c["hi"] <= node["lo"]).alias("before"), side(lambda c: c["lo"] >= node["hi"]).alias("behind"))


def attach_paths(levels: list[Stored], above: Callable[[DataFrame], DataFrame], brought: Sequence[str], extra: Sequence[str], label: str) -> DataFrame:
    """``tree``, ``digest``, ``path``, ``brought`` and ``extra`` of every leaf; the path has its siblings on the way to the root, lowest level first.

    ``above`` adds ``path`` and ``brought`` to one row per ``tree``: the way from the top of the tree to the root of a tree above it.
    """
    whole = F.col("hi") - F.col("lo") == F.col("total")
    known = above(levels[-1].df.filter(whole))
    for level in range(len(levels) - 1, 0, -1):
        bucket = F.expr(f"lo div {FAN ** (level + 1)}")
        renamed = [F.col(c).alias(f"__{c}") for c in ("tree", "lo", "hi", "children", "path")]
        parents = known.select(*renamed, bucket.alias("__bucket"), *brought)
        below = levels[level - 1].df.filter(~whole).withColumn("bucket", bucket)
        inside = F.col("tree").eqNullSafe(F.col("__tree")) & (F.col("bucket") == F.col("__bucket"))
        inside = inside & (F.col("lo") >= F.col("__lo")) & (F.col("hi") <= F.col("__hi"))
        step = _step(F.col("__children"), F.struct("lo", "hi"))
        attached = below.join(parents, inside).select(*levels[level - 1].df.columns, F.concat(F.array(step), "__path").alias("path"), *brought)
        known = materialize(attached.unionByName(above(levels[level - 1].df.filter(whole))), f"{label}-paths").df
    leaves = known.select("total", "tree", "path", *brought, "children", F.explode("children").alias("node"))
    step = F.array(_step(F.col("children"), F.col("node")))
    path = F.when(F.col("total") == 1, F.col("path")).otherwise(F.concat(step, "path"))
    return leaves.select("tree", F.col("node.digest").alias("digest"), path.alias("path"), *brought, *[F.col(f"node.{c}").alias(c) for c in extra])


def manifest(df: DataFrame, group: str, key: str, columns: Sequence[str], carry: dict[str, Column] | None = None) -> DataFrame:
    """``key``, ``leaf``, ``subroot``, ``root``, ``path`` of every row, and what ``carry`` computes of it.

    A leaf is the digest of the cells of ``columns``; rows of one ``group`` form a tree in ascending order of ``key``; the
    trees' roots, in ascending order of the group (text, byte by byte), form the tree of ``root``.
    """
    carry = carry or {}
    named = {f"c{i}": column for i, column in enumerate(carry.values())}
    leaves = df.select(
        F.col(group).cast("string").alias("tree"),
        F.col(key).alias("key"),
        digest(*[cell(F.col(c)) for c in columns]).alias("digest"),
        *[c.alias(n) for n, c in named.items()],
    )
    extra = ["key", *named]
    order = [F.asc_nulls_first(c) for c in ("key", "digest", *named)]
    levels, tops = build(_ranked(leaves, order, "rows"), extra, "rows")

    groups = tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    upper, top = build(_ranked(groups, [F.asc_nulls_first("name")], "groups"), ["name"], "groups")
    ways = attach_paths(upper, lambda rows: rows.withColumn("path", F.array().cast(_PATH)), [], ["name"], "groups")
    root = top.select("digest").first()
    stored = materialize(ways.select(F.col("name").alias("__name"), F.col("digest").alias("subroot"), F.col("path")), "group-paths").df

    def above(rows: DataFrame) -> DataFrame:
        return rows.join(stored, F.col("tree").eqNullSafe(F.col("__name"))).drop("__name")

    found = attach_paths(levels, above, ["subroot"], extra, "rows")
    return found.select(
        F.col("key").alias(key),
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root.digest if root else None).cast("string").alias("root"),
        "path",
        *[F.col(n).alias(name) for n, name in zip(named, carry, strict=True)],
    )
