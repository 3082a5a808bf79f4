"""Mixing sources to target weights by hash-threshold histograms.

Each document has a 60-bit hash of its id and text.  A source whose target is
r times its size takes every document floor(r) times, and once more those
whose hash lies below the source's threshold.  The threshold is found without
sorting: sizes are summed by (source, top 12 bits of the hash), the bucket in
which the running sum crosses the budget is refined by the next 12 bits, and so
on until that bucket holds one document (or all 60 bits are used).  Thresholds
are nested: a larger budget takes a superset.

Scale: texts are read once, into a written narrow table (id, source, size, hash).
Each level aggregates it with map-side partials to at most 4096 rows per source, so a
hot source never meets in one task; later levels read the boundary buckets only.

Defined cases: null text has size 0 (taken 0); a null source is a source of its
own, last in order; null ids hash as such; rows equal in id, text and source are numbered and hashed with
their number, so each is taken or left by itself; texts of any length are counted whole; other columns may
have any names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_join, words, written

WEIGHTS = (5, 2, 1)      # by rank of the source, repeating
SHARE = 1.5              # words of the mix, as a multiple of all sizes
MOST_REPEATS = 2         # a source is used at most so many times
HASH_BITS = 60
LEVEL_BITS = 12


def source_key(source: Column) -> Column:
    """Never-null key: null is a source of its own."""
    return F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source))


def taken_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it; rows equal in id, text and source are one that stands for all of them."""
    out = mix(docs, id_col, text_col, source_col).where("copies > 0").select("doc_id", "src", "first", "copies")
    times = written(out.groupBy("doc_id", "src", "first").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows")), "mix-times")
    # the row travels whole in one column, so no name of its own columns clashes
    packed = docs.select(F.col(id_col).alias("id"), source_key(F.col(source_col)).alias("own"),
                         doc_hash(F.col(id_col), F.col(text_col)).alias("h"), F.struct("*").alias("row"))
    if times.where("rows > 1").limit(1).count():
        packed = packed.groupBy("id", "own", "h").agg(F.min("row").alias("row"))
    met = (packed.h == times["first"]) & (packed.own == times.src) & packed.id.eqNullSafe(times.doc_id)
    return packed.join(times, met).select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")


def doc_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of md5(id, text)."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit("\x1f"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, src, size, h): the narrow table every later step reads."""
    return docs.select(
        F.col(id_col).alias("doc_id"), source_key(F.col(source_col)).alias("src"),
        F.size(words(F.col(text_col))).cast("long").alias("size"),
        doc_hash(F.col(id_col), F.col(text_col)).alias("h"))


def told_apart(narrow: DataFrame) -> DataFrame:
    """``narrow`` (a written table) with a hash of its own for each of its equal rows.

    Equal rows are counted in each input partition and numbered on from the partitions before, so a row that
    makes up much of a table is dealt over as many tasks as held it.  The first of them keeps its hash.
    """
    row = ["doc_id", "src", "size", "h", "first"]
    if not narrow.groupBy(*row).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        return narrow
    parts = narrow.groupBy(*row, F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(*row).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    numbers = parts.withColumn("from", F.coalesce(before, F.lit(0))).select(
        *row, F.explode(F.sequence(F.col("from"), F.col("from") + F.col("n") - 1)).alias("k"))
    return written(numbers.withColumn("h", F.when(F.col("k") == 0, F.col("h")).otherwise(nth_hash(F.col("h"), F.col("k"))))
                   .select(*row), "mix-numbered")


def nth_hash(h: Column, k: Column) -> Column:
    """60 bits of md5(h, k): the hash of the equal row number k of those that share h."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", h.cast("string"), k.cast("string"))), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
            most: int = MOST_REPEATS) -> DataFrame:
    """(src, source_size, target) from (src, source_size): one row per source.

    Water filling in closed form: sources in order of cap / weight; those whose
    share at the running level reaches their cap stop there, the first that does
    not fixes the level of all that follow.  The windows run over one row per
    source.
    """
    ordered = Window.orderBy(F.substring("src", 1, 1).desc(), "src")
    w = F.lit(list(weights))[F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights)))]
    s = (sources.withColumn("w", w.cast("double")).withColumn("cap", (most * F.col("source_size")).cast("double"))
         .withColumn("total", F.lit(share) * F.sum("source_size").over(Window.partitionBy())))
    fill = Window.orderBy(F.col("cap") / F.col("w"), "src")
    before = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    s = s.withColumn("level", (F.col("total") - before) / F.sum("w").over(fill.rowsBetween(0, Window.unboundedFollowing)))
    s = s.withColumn("open", F.col("w") * F.col("level") < F.col("cap")).withColumn("n", F.row_number().over(fill))
    first = F.min(F.when(F.col("open"), F.struct("n", "level"))).over(Window.partitionBy())
    s = s.withColumn("first", first)
    return s.select("src", "source_size",
                    F.when(F.col("n") >= F.col("first.n"), F.col("w") * F.col("first.level"))
                    .otherwise(F.col("cap")).alias("target"))


def thresholds(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """(src, threshold): hashes below it sum nearest to the source's budget.

    ``docs`` has (src, size, h), ``budgets`` (src, budget); both are written tables.
    """
    open_ = budgets.select("src", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    shift = HASH_BITS
    while True:
        inside = small_join(docs, open_.select("src", "prefix"), ["src"])
        inside = inside.where(F.shiftright("h", shift) == F.col("prefix"))
        shift -= LEVEL_BITS
        hist = (inside.groupBy("src", F.shiftright("h", shift).alias("bucket"))
                .agg(F.sum("size").alias("s"), F.min("h").alias("lo"), F.max("h").alias("hi")))
        run = Window.partitionBy("src").orderBy("bucket")
        crossed = (small_join(hist, open_.select("src", "budget", "below"), ["src"])
                   .withColumn("upto", F.col("below") + F.sum("s").over(run))
                   .where((F.col("upto") >= F.col("budget")) & (F.col("upto") - F.col("s") < F.col("budget")))
                   .withColumn("k", F.row_number().over(run)).where("k = 1"))
        open_ = written(crossed.select("src", "budget", F.col("bucket").alias("prefix"),
                                       (F.col("upto") - F.col("s")).alias("below"), "s", "lo", "hi"), "mix-level")
        if shift == 0 or open_.where("lo < hi").limit(1).count() == 0:
            break
    # the boundary group is taken if that comes nearer to the budget
    near = (F.col("below") + F.col("s") - F.col("budget")) < (F.col("budget") - F.col("below"))
    return open_.select("src", F.when(near, F.col("hi") + 1).otherwise(F.col("lo")).alias("threshold"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST_REPEATS) -> DataFrame:
    """(doc_id, src, size, h, first, source_size, target, copies, taken): how often the mix takes each row.

    ``h`` is the row's hash, ``first`` that of its id and text: equal rows share it.
    """
    narrow = told_apart(written(sized(docs, id_col, text_col, source_col).withColumn("first", F.col("h")), "mix-sizes"))
    goal = written(targets(narrow.groupBy("src").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets")
    # a source without words has no budget to divide
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = goal.withColumn("whole", whole.cast("long"))
    plan = plan.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    cut = thresholds(narrow, written(plan.where("budget > 0").select("src", "budget"), "mix-budgets"))
    plan = written(plan.join(cut, "src", "left").select("src", "source_size", "target", "whole", "threshold"), "mix-plan")
    copies = F.col("whole") + F.coalesce((F.col("h") < F.col("threshold")).cast("long"), F.lit(0))
    return (small_join(narrow, plan, ["src"])
            .withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
            .drop("whole", "threshold"))
