"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document into a ledger row: the measurements
and one failure bit per rule.  A policy is a versioned bit mask over the
rules; applying another policy, or asking what each rule costs (ablation),
reads only the ledger.

All measurements are computed inside the row by DataFrame functions, so no
text is shuffled and a document's cost follows its own length.

Defined cases: null and empty text have no words, no lines with a word and no
symbols, fail ``too_few_words`` and are not kept; repeated rows each get their
own ledger row; an empty table gives an empty ledger.  Columns other than the
id and the text are not read, so names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words

WINDOW_WORDS = 5
SYMBOLS = "#*$%&|<>"

#: Rules by bit, as SQL conditions over the ledger's measurements.
RULES = [
    ("too_few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("short_words", "n_words > 0 AND word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("symbols", "10 * n_symbols > 3 * n_words"),
    ("duplicate_lines", "n_dup_lines >= 4 AND 2 * n_dup_lines > n_lines"),
]
BASE = ("too_few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A version of the verdict: the rules that reject a document."""
    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << bit for bit, (name, _) in enumerate(RULES) if name in self.rules)


BASE_POLICY = Policy("base-1", BASE)
DEFAULT_POLICY = Policy("all-1", tuple(name for name, _ in RULES))


def repeat_words(w: Column) -> Column:
    """Number of words inside 5-word windows found twice or more in the array.

    Windows are compared by 64-bit hash within their document.  Only documents
    with a repeated hash are sorted.
    """
    k = WINDOW_WORDS

    def covered(positions: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(-k).alias("last"))
        return F.aggregate(
            positions, start,
            lambda acc, p: F.struct((acc["n"] + F.least(F.lit(k), p - acc["last"])).alias("n"), p.alias("last")),
            lambda acc: acc["n"])

    def repeated(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(o: Column) -> Column:
            same = F.filter(o, lambda x, i: (x["h"] == F.get(o, i - 1)["h"]) | (x["h"] == F.get(o, i + 1)["h"]))
            return F.sort_array(F.transform(same, lambda x: x["i"]))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            covered(let(ordered, positions)))

    def windows(a: Column) -> Column:
        # element by element: slice() would copy the whole array for every window
        return F.transform(F.sequence(F.lit(0), F.size(a) - k), lambda i: F.xxhash64(*[F.get(a, i + j) for j in range(k)]))

    return let(w, lambda a: F.when(F.size(a) <= k, F.lit(0)).otherwise(let(windows(a), repeated)))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per document: id, measurements, ``failed`` (bit i = rule i failed) and the columns to carry along."""
    extra = carry or []
    text = F.coalesce(F.col(text_col), F.lit(""))

    def measures(w: Column) -> Column:
        chars = F.aggregate(w, F.lit(0), lambda n, x: n + F.length(x))
        return F.struct(F.size(w).cast("long").alias("n_words"), chars.cast("long").alias("word_chars"),
                        repeat_words(w).cast("long").alias("n_repeat_words"))

    def lines(a: Column) -> Column:
        return F.struct(F.size(a).cast("long").alias("n_lines"),
                        (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"))

    worded = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    measured = docs.select(
        F.col(id_col), *extra,
        let(words(text), measures).alias("_w"),
        let(worded, lines).alias("_l"),
        F.length(F.regexp_replace(text, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
    ).select(id_col, *extra, "_w.n_words", "_w.word_chars", "n_symbols", "_l.n_lines", "_l.n_dup_lines", "_w.n_repeat_words")
    bits = [F.when(F.expr(cond), F.lit(1 << bit)).otherwise(F.lit(0)) for bit, (_, cond) in enumerate(RULES)]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measured.withColumn("failed", failed.cast("long"))


def fails(policy: Policy) -> Column:
    """Whether a ledger row fails any rule of the policy."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) != 0


def apply_policy(led: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Ledger with ``base_failed``, ``kept`` and the policy's version."""
    return (led.withColumn("base_failed", fails(BASE_POLICY))
            .withColumn("kept", ~fails(BASE_POLICY) & ~fails(policy))
            .withColumn("policy", F.lit(policy.version)))


def ablation(led: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Per rule of the policy: documents failing it, and documents that only it rejects.

    The ledger is first counted by failure mask (at most 2^rules rows), and
    every rule reads those counts.
    """
    masks = (led.select(F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("m"))
             .groupBy("m").agg(F.count(F.lit(1)).alias("n")))
    rules = F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << bit).cast("long").alias("bit"))
                                for bit, (name, _) in enumerate(RULES) if name in policy.rules]))
    return (masks.select("m", "n", rules.alias("r"))
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("m").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("m") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only")))


def keep(docs: DataFrame, policy: Policy = DEFAULT_POLICY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that the base rules or the policy reject; columns and repeated rows stay."""
    own = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    led = ledger(own, "doc_id", "text", carry=["_row"])
    return apply_policy(led, policy).where("kept").select("_row.*")
