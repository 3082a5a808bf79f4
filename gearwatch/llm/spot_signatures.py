"""SpotSigs document fingerprints.

A spot signature starts at an antecedent, a very common word of a language, and
chains the next two content words (words that are no antecedents) among the
six words after it.  The set of a document's signatures is its fingerprint; documents are
compared by Jaccard likeness of their sets.  Likeness cannot exceed the
shorter length over the longer: the pair search partitions sets by length so
that only neighbouring partitions can hold a pair, and compares a pair only if
the lengths allow it and both sets hold one of their rarest signatures in common.

All work is DataFrame functions.  A signature is hashed to 32 bits, a set is a
sorted array of them built inside the document's row.

Defined cases: null text is empty; a text with words but without a signature
has one, the hash of all its words; a text without words has the empty fingerprint, and two empty
fingerprints have likeness 1; rows that share a doc_id have one common next
document, and where several rows share the next doc_id, the smallest text of
them is that document; a null doc_id comes last; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, words, written

CHAIN = 2                # content words in a signature
REACH = 6                # words after the antecedent that may hold them
#: Very common words of the languages, the antecedents.
ANTECEDENTS = tuple(
    "the a an of to and in is was be are it that this for on with as by at from "
    "der die das und ist ein eine von zu mit den im auf "
    "le la les de des et un une est que en du pour dans "
    "el los las y del por con para se su es".split())
THRESHOLD = 0.5
NO_ID = -2**63


def signatures(text: Column) -> Column:
    """Sorted distinct 32-bit hashes of the spot signatures of a text."""
    stop = F.lit(list(ANTECEDENTS))

    def chains(w: Column) -> Column:
        marked = F.transform(w, lambda x: F.when(~F.array_contains(stop, x), x))  # antecedents become null

        def chain(m: Column) -> Column:
            def at(i: Column) -> Column:
                after = F.filter(F.array(*[F.get(m, i + k) for k in range(1, REACH + 1)]), lambda x: x.isNotNull())
                return let(after, lambda c: F.when(F.size(c) >= CHAIN, F.hash(F.get(w, i), *[F.get(c, F.lit(k)) for k in range(CHAIN)])))

            spots = F.filter(F.transform(m, lambda x, i: F.when(x.isNull(), i)), lambda i: i.isNotNull())
            return F.array_compact(F.transform(spots, at))

        return let(marked, chain)

    def all_words(w: Column) -> Column:
        return let(chains(w), lambda c: F.when((F.size(c) == 0) & (F.size(w) > 0), F.array(F.hash(w))).otherwise(c))

    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[.,;:!?\"()]+", "")
    return F.sort_array(F.array_distinct(let(words(plain), all_words)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature sets; 1 for two empty ones."""
    both = let(F.array_intersect(a, b), F.size)
    total = F.size(a) + F.size(b)
    shared = F.when(F.least(F.size(a), F.size(b)) == 0, F.lit(0)).otherwise(both)
    return F.when(total == 0, F.lit(1.0)).otherwise(let(shared, lambda s: s / (total - s))).cast("double")


def as_text(sigs: Column) -> Column:
    """A fingerprint as text: its signatures in hexadecimal, comma-joined."""
    return F.array_join(F.transform(sigs, lambda s: F.lower(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))))), ",")


def following(ids: DataFrame) -> DataFrame:
    """(id, next): the next smaller id, and for the smallest the largest; ``ids`` has each id once.

    Ids are dealt into ranges; inside a range a window finds the next id, the
    ends of ranges come from a table of one row per range.
    """
    ranged = written(ids.repartitionByRange(F.col("id")).withColumn("part", F.spark_partition_id()), "spot-ranges")
    ends = ranged.groupBy("part").agg(F.max("id").alias("top"))
    ends = ends.select("part", F.coalesce(F.lag("top").over(Window.orderBy("part")),
                                          F.max("top").over(Window.partitionBy())).alias("below"))
    inside = ranged.withColumn("next", F.lead("id").over(Window.partitionBy("part").orderBy(F.desc("id"))))
    return inside.join(ends, "part").select("id", F.coalesce("next", "below").alias("next"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, edited, sigs, edited_sigs, next_sigs) of every row.

    The texts are shuffled once, by id; the next document sends the code points
    that replace the end of this one and its signatures.
    """
    own = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sizes = written(own.select("id", F.length("text").alias("n")).groupBy("id")
                    .agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("rows")), "spot-sizes")
    order = written(following(sizes.select("id")).join(sizes, "id").select(F.col("id").alias("to"), "n", F.col("next").alias("id")), "spot-order")
    signed = own.withColumn("sigs", signatures(F.col("text")))
    senders = signed
    if sizes.where("rows > 1").limit(1).count():  # an id stands for its smallest text
        senders = own.groupBy("id").agg(F.min("text").alias("text")).withColumn("sigs", signatures(F.col("text")))
    sent = senders.join(order, "id").select(
        F.col("to").alias("id"), F.substring(F.col("text"), F.lit(1), F.floor(F.col("n") / 3).cast("int")).alias("part"),
        F.col("sigs").alias("next_sigs"))
    met = signed.join(sent, "id").withColumn("cut", F.floor(F.length("text") / 3).cast("int"))
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - F.col("cut")),
                      F.substring(F.col("part"), F.lit(1), F.col("cut")))
    return (met.withColumn("edited", edited)
            .select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "text", "edited", "sigs",
                    signatures(F.col("edited")).alias("edited_sigs"), "next_sigs"))


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, likeness) of documents whose different fingerprints reach the threshold, ids of representatives.

    Equal fingerprints are one class, represented by its smallest id.  Sets are
    partitioned by the logarithm of their length to base 1/threshold, so a pair
    lies in one partition or two neighbours.
    """
    own = docs.select(F.col(id_col).alias("id"), signatures(F.col(text_col)).alias("sigs")).where(F.size("sigs") > 0)
    sets = written(own.groupBy("sigs").agg(F.min("id").alias("id")), "spot-sets")
    element = sets.select("id", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    counts = element.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    rare = element.join(counts, "sig").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("e"))
    # signatures of one set only come first in the order; they cannot be shared
    spare = F.col("n") - F.ceil(F.lit(threshold) * F.col("n")).cast("int") + 1 - (F.col("n") - F.size("e"))
    index = rare.where(spare > 0).select("id", "n", F.explode(F.slice("e", F.lit(1), spare)).alias("e"))
    index = index.select("id", "n", "e.sig", F.floor(F.log("n") / F.lit(-math.log(threshold))).alias("part"))
    left = index.select(F.col("id").alias("a"), F.col("n").alias("na"), "sig", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = index.select(F.col("id").alias("b"), F.col("n").alias("nb"), "sig", "part")
    pairs = (left.join(right, ["sig", "part"]).where((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
             .where(F.col("na") >= F.lit(threshold) * F.col("nb")).select("a", "b").distinct())
    side = lambda x: sets.select(F.col("id").alias(x), F.col("sigs").alias(f"s{x}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness")).where(F.col("likeness") >= threshold))
