"""Named data-quality rules ("expectations") over DataFrames.

A rule is a SQL boolean.  A row passes only when the condition is TRUE; a
NULL result counts as a violation (a plain ``NOT cond`` count would miss
NULLs).  Violation counts come from the same job that produces the rows
(``Observation``), or from a one-pass global aggregate (``quality_report``):
partial counts per task, one final row, no shuffle of data.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import config as C

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    action: str = WARN

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


SILVER_RULES = (
    Rule(*C.RULE_VALID_VIBRATION, action=DROP),
    Rule(*C.RULE_VALID_TEMPERATURE, action=DROP),
    Rule(*C.RULE_VALID_PRESSURE, action=WARN),
)


def _violation_metrics(rules) -> list[Column]:
    return [F.count_if(~r.passes()).alias(r.name) for r in rules]


def expect(df: DataFrame, rules, name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Keep every row; count violations per rule in the same job."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("_rows"), *_violation_metrics(rules)), obs


def expect_or_drop(df: DataFrame, rules, name: str = "expectations") -> tuple[DataFrame, Observation]:
    """Drop rows violating any DROP rule; count every rule's violations.

    Counts are observed on the input (before the drop), so they are per rule
    and independent of rule order.  FAIL rules raise after the action when
    ``check_failures`` is called with the observation.
    """
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("_rows"), *_violation_metrics(rules))
    keep = [r.passes() for r in rules if r.action == DROP]
    if keep:
        cond = keep[0]
        for c in keep[1:]:
            cond = cond & c
        observed = observed.where(cond)
    return observed, obs


def check_failures(obs: Observation, rules) -> None:
    """Raise when a FAIL rule saw a violation (call after an action)."""
    metrics = obs.get
    bad = [r.name for r in rules if r.action == FAIL and metrics.get(r.name, 0)]
    if bad:
        raise ValueError(f"expectation failed: {', '.join(bad)}")


def quality_report(df: DataFrame, rules=SILVER_RULES) -> DataFrame:
    """D3: one row per rule: rule, action, passed, failed (one pass over df)."""
    aggs = []
    for i, r in enumerate(rules):
        aggs += [F.count_if(r.passes()).alias(f"p{i}"), F.count_if(~r.passes()).alias(f"f{i}")]
    wide = df.agg(*aggs)
    stacked = ", ".join(f"'{r.name}', '{r.action}', p{i}, f{i}" for i, r in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {stacked}) AS (rule, action, passed, failed)")


def failure_mask(rules) -> Column:
    """Bit i is set where a row fails rule i; up to 63 rules."""
    bits = [F.when(r.passes(), F.lit(0)).otherwise(F.lit(1 << i)).cast("long") for i, r in enumerate(rules)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long"))


def marked(df: DataFrame, rules=SILVER_RULES, column: str = "failed_rules") -> DataFrame:
    """D1 by row: every row with the bits of the rules it fails, so a warned row can be found later."""
    return df.withColumn(column, failure_mask(rules))


def mask_counts(rows: DataFrame, column: str = "failed_rules") -> DataFrame:
    """(mask, rows) of a marked table: all that reports and other choices of rules need, a row per combination that occurs."""
    return rows.groupBy(F.col(column).alias("mask")).agg(F.count(F.lit(1)).alias("rows"))


def report_of_masks(counts: DataFrame, rules=SILVER_RULES) -> DataFrame:
    """D3 from ``mask_counts``: (rule, action, passed, failed), without a scan of the rows."""
    def total(bit: int, wanted: bool) -> Column:
        fails = F.col("mask").bitwiseAND(F.lit(1 << bit)) != 0
        return F.coalesce(F.sum(F.when(fails if wanted else ~fails, F.col("rows"))), F.lit(0)).cast("long")

    lines = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.action).alias("action"),
                      total(i, False).alias("passed"), total(i, True).alias("failed")) for i, r in enumerate(rules)]
    return counts.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def passing(rows: DataFrame, names: list[str], rules=SILVER_RULES, column: str = "failed_rules") -> DataFrame:
    """The rows of a marked table that pass the rules ``names``, whatever their action was when they were marked."""
    unknown = set(names) - {r.name for r in rules}
    if unknown:
        raise KeyError(f"no such rules: {sorted(unknown)}")
    bits = sum(1 << i for i, r in enumerate(rules) if r.name in names)
    return rows.where(F.col(column).bitwiseAND(F.lit(bits)) == 0)
