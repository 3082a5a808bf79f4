"""Merkle manifest of a dataset by lag and lead windows.

Each row is a leaf, a digest of its columns.  Within a source the leaves stand in order of id, and every
``FANOUT`` consecutive nodes have a parent, level by level, until one is left, the source's subroot; the
subroots, in order of source, make a tree of their own up to the root.  On each level the lag and lead
columns at the offsets 1 to ``FANOUT`` - 1, masked by a node's slot in its run and by the length of the run,
are its siblings; the first child's row hashes its parent from its leads.  A proof is the list of (left, right)
siblings from a leaf to the root; folding a leaf with them must give the root.

Scale: texts are hashed once into a written table of digests.  Leaves are numbered by dealt ranges, so a
source that holds a third of all rows is dealt like any other; windows hold 16 runs of one level, and each
level has a sixteenth of the nodes of the one below.  Proofs are made from the top down: a level's
rows meet their parents' path, one row for each run.  The driver sees the count of the largest source and the root.

Defined cases: a null column is hashed as such, an empty text as zero bytes; a null source is a source of its own
and first; null ids stand first in their source; equal ids are ordered by leaf, and equal rows are leaves
each by itself (which of them has which place does not matter); a text of any length is one value;
columns other than the hashed ones are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, written

FANOUT = 16
RUNS = 16                # runs of siblings in one window
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def node(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(*values: Column) -> Column:
    """Digest of a row's values: each ``-`` if null, else its length in UTF-8 bytes, a colon and itself."""
    shown = [v.cast("string") for v in values]
    return node(*[F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s)) for s in shown])


def group_key(source: Column) -> Column:
    """Never null and ordered like the source, null first."""
    text = source.cast("string")
    return F.when(text.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), text))


def siblings(nodes: DataFrame) -> DataFrame:
    """``nodes`` (grp, at, n, digest) with ``run`` and the digests ``left`` and ``right`` of each node in its run."""
    w = Window.partitionBy("grp", "_block").orderBy("at")
    slot = F.col("at") % FANOUT
    length = F.least(F.lit(FANOUT).cast("long"), F.col("n") - F.col("run") * FANOUT)
    lags = [F.when(slot >= d, F.lag("digest", d).over(w)) for d in range(FANOUT - 1, 0, -1)]
    leads = [F.when(slot + d < length, F.lead("digest", d).over(w)) for d in range(1, FANOUT)]
    run = nodes.withColumn("run", F.floor(F.col("at") / FANOUT)).withColumn("_block", F.floor(F.col("at") / (FANOUT * RUNS)))
    return run.withColumns({"left": F.concat_ws("", *lags), "right": F.concat_ws("", *leads)}).drop("_block")


def parents(nodes: DataFrame) -> DataFrame:
    """The next level (grp, at, n, digest), hashed at the rows of first children."""
    first = siblings(nodes).where(F.col("at") % FANOUT == 0)
    return first.select("grp", F.col("run").alias("at"), F.ceil(F.col("n") / FANOUT).alias("n"),
                        node(F.col("digest"), F.col("right")).alias("digest"))


def grow(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame | None]:
    """Written levels of each group's tree, the leaves first, and its top: (grp, level, digest); None without leaves."""
    levels, tops = [nodes], None
    while True:
        level = levels[-1]
        done = level.where("n = 1").select("grp", F.lit(len(levels) - 1).alias("level"), "digest")
        tops = done if tops is None else tops.unionByName(done)
        most = level.agg(F.max("n")).first()[0]
        if most is None:
            return levels, None
        if most == 1:
            return levels, written(tops, f"{name}-tops")
        levels.append(written(parents(level.where("n > 1")), f"{name}-level"))


def descend(levels: list[DataFrame], tops: DataFrame, carry: list[str], name: str) -> DataFrame:
    """Leaves with ``path``: the (left, right) of a node and of all nodes above it, lowest first.

    ``tops`` has (grp, level, path) and the columns to carry down to each leaf.
    """
    down = None
    for k in range(len(levels) - 1, -1, -1):
        ended = tops.where(F.col("level") == k).select("grp", F.lit(0).cast("long").alias("at"), "path", *carry)
        rows = levels[k].join(ended, ["grp", "at"]).where("n = 1")
        if down is not None:
            above = down.select("grp", F.col("at").alias("run"), F.col("path").alias("_above"), *carry)
            step = F.array(F.struct("left", "right"))
            inner = (siblings(levels[k].where("n > 1")).join(above, ["grp", "run"])
                     .withColumn("path", F.concat(step, F.col("_above"))).drop("run", "left", "right", "_above"))
            rows = rows.unionByName(inner)
        down = written(rows.select("grp", "at", "path", *carry), f"{name}-paths") if k else rows
    return down


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, start, lambda digest, step: node(step["left"], digest, step["right"]))


def proof_digest(path: Column) -> Column:
    """SHA-256 of a proof's siblings, left to right, from the lowest level up."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def counted(rows: DataFrame) -> DataFrame:
    """``rows`` with ``n``, the number of rows of their group."""
    return rows.join(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "grp")


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source",
             also: dict[str, Column] | None = None) -> DataFrame:
    """(id, leaf, subroot, root, path) of every row, and the columns ``also`` of ``docs``."""
    own = {f"_also_{i}": c for i, c in enumerate((also or {}).values())}
    narrow = docs.select(group_key(F.col(source_col)).alias("grp"), F.col(id_col).cast("long").alias("id"),
                         leaf(*[F.col(f) for f in fields]).alias("digest"), *[c.alias(k) for k, c in own.items()])
    rows = numbered(written(narrow, "merkle-leaves"), ["grp"], ["id", "digest"], "merkle-ranges")
    nodes = written(counted(rows), "merkle-level")
    levels, tops = grow(nodes, "merkle")
    if tops is None:
        return docs.sparkSession.createDataFrame([], _schema(nodes, own, also))
    subroots = tops.select(F.lit("").alias("grp"), F.col("grp").alias("src"), "digest")
    upper = counted(numbered(written(subroots, "merkle-subroots"), ["grp"], ["src"], "merkle-sources"))
    high, top = grow(written(upper, "merkle-sources"), "merkle-top")
    root = top.first()["digest"]
    step = "array<struct<left:string,right:string>>"
    base = descend(high, top.select("grp", "level", F.array().cast(step).alias("path")), [], "merkle-top")
    base = base.select(F.col("src").alias("grp"), "path", F.col("digest").alias("subroot"))
    base = written(tops.select("grp", "level").join(base, "grp"), "merkle-base")
    found = descend(levels, base, ["subroot"], "merkle")
    return found.select("id", F.col("digest").alias("leaf"), "subroot", F.lit(root).alias("root"), "path",
                        *[F.col(k).alias(name) for k, name in zip(own, also or {}, strict=True)])


def _schema(nodes: DataFrame, own: dict, also: dict | None) -> str:
    types = dict(nodes.dtypes)
    extra = "".join(f", `{name}` {types[k]}" for k, name in zip(own, also or {}, strict=True))
    return f"id long, leaf string, subroot string, root string, path array<struct<left:string,right:string>>{extra}"


def verified(rows: DataFrame, found: Column) -> DataFrame:
    """``rows`` of a manifest held against the leaves ``found`` now: ``folded_root`` and ``verified``."""
    again = rows.withColumn("folded_root", fold(found, F.col("path")))
    return again.withColumn("verified", F.col("folded_root") == F.col("root"))
