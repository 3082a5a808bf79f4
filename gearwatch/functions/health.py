"""Equipment status, remaining useful life, maintenance priority.

The rules are tables in ``config`` (limits per level, penalty per signal,
points per grade).  From one table come both forms of a function: the Column
builder of the DataFrame API and the SQL function registered in the session.
Both are plain expressions, so Catalyst inlines and constant-folds them
inside whole-stage codegen - no Python UDF anywhere.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C


def _col(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def status_of(vibration, temperature) -> Column:
    """U1 assess_vibration_status: the first level either signal is above.

    A NULL signal never raises the level; the other signal still decides.
    """
    signals = [_col(vibration), _col(temperature)]
    level = F  # F.when starts the chain, Column.when goes on
    for label, *limits in C.STATUS_LIMITS:
        level = level.when(reduce(or_, [s > x for s, x in zip(signals, limits, strict=True)]), label)
    return level.otherwise(C.STATUS_NORMAL)


def estimate_rul(operating_hours, avg_vibration, avg_temperature,
                 max_operating_hours=C.RUL_MAX_OPERATING_HOURS) -> Column:
    """Design life less hours and the penalty of each signal, at least 0, in DOUBLE.

    GREATEST skips NULL at both levels: a NULL hours or vibration yields
    0.0 (as in the reference), a NULL temperature adds no temperature
    penalty.
    """
    hours, life = (_col(x).cast("double") for x in (operating_hours, max_operating_hours))
    left = life - hours
    for signal, (free, weight) in zip((avg_vibration, avg_temperature), C.RUL_PENALTIES, strict=True):
        s = _col(signal).cast("double")
        left = left - (s if free is None else F.greatest(s - F.lit(free), F.lit(0))) * F.lit(weight)
    return F.greatest(F.lit(0.0), left)


def criticality_points(criticality) -> Column:
    points = F
    for grade, value in C.CRITICALITY_POINTS.items():
        points = points.when(_col(criticality) == grade, F.lit(value))
    return points.otherwise(F.lit(C.CRITICALITY_POINTS_OTHER))


def priority_score(rul_hours, criticality, last_maintenance_days) -> Column:
    """clamp(0..100) of (1 - rul/10000)*40 + grade points + min(days/10, 30).

    NULL rul -> 0.0 (GREATEST skips the NULL sum); NULL days -> the 30 cap.
    """
    used = F.lit(1) - _col(rul_hours).cast("double") / F.lit(C.PRIORITY_RUL_SCALE)
    age = _col(last_maintenance_days).cast("int") / F.lit(C.PRIORITY_DAYS_DIVISOR)
    raw = used * F.lit(C.PRIORITY_RUL_WEIGHT) + criticality_points(criticality) + F.least(age, F.lit(C.PRIORITY_DAYS_CAP))
    return F.least(F.lit(100.0), F.greatest(F.lit(0.0), raw))


def _case(arms, other) -> str:
    return " ".join(["CASE", *[f"WHEN {test} THEN {value}" for test, value in arms], f"ELSE {other} END"])


def _status_sql(*signals: str) -> str:
    tests = [" OR ".join(f"{s} > {x}" for s, x in zip(signals, limits, strict=True)) for _, *limits in C.STATUS_LIMITS]
    labels = [f"'{label}'" for label, *_ in C.STATUS_LIMITS]
    return _case(zip(tests, labels, strict=True), f"'{C.STATUS_NORMAL}'")


def _rul_sql(life: str, hours: str, *signals: str) -> str:
    terms = [hours]
    for s, (free, weight) in zip(signals, C.RUL_PENALTIES, strict=True):
        terms.append(f"{s if free is None else f'greatest({s} - {free}, 0)'} * {weight}")
    return f"greatest(0, {' - '.join([life, *terms])})"


def _priority_sql(rul: str, grade: str, days: str) -> str:
    points = _case([(f"{grade} = '{g}'", p) for g, p in C.CRITICALITY_POINTS.items()], C.CRITICALITY_POINTS_OTHER)
    terms = [f"(1 - {rul} / {C.PRIORITY_RUL_SCALE}) * {C.PRIORITY_RUL_WEIGHT}", points,
             f"least({days} / {C.PRIORITY_DAYS_DIVISOR}, {C.PRIORITY_DAYS_CAP})"]
    return f"least(100, greatest(0, {' + '.join(terms)}))"


#: name -> (parameters, result type, body)
SQL_FUNCTIONS = {
    "assess_vibration_status": (
        "vibration_rms DOUBLE, temperature DOUBLE", "STRING", _status_sql("vibration_rms", "temperature")),
    "estimate_rul": (
        "operating_hours DOUBLE, avg_vibration DOUBLE, avg_temperature DOUBLE, "
        f"max_operating_hours DOUBLE DEFAULT {C.RUL_MAX_OPERATING_HOURS}", "DOUBLE",
        _rul_sql("max_operating_hours", "operating_hours", "avg_vibration", "avg_temperature")),
    "maintenance_priority_score": (
        "rul_hours DOUBLE, equipment_criticality STRING, last_maintenance_days INT", "DOUBLE",
        _priority_sql("rul_hours", "equipment_criticality", "last_maintenance_days")),
}


def register_sql_functions(spark: SparkSession, temporary: bool = True) -> list[str]:
    """Create (or replace) the three SQL functions, described, in the session or the catalog."""
    kind = "TEMPORARY FUNCTION" if temporary else "FUNCTION"
    for name, (parameters, result, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE {kind} {name}({parameters}) RETURNS {result} "
                  f"COMMENT '{C.FUNCTION_COMMENTS[name]}' RETURN {body}")
    return list(SQL_FUNCTIONS)


def score_fleet(summary: DataFrame, status_cols=("avg_vibration", "avg_temperature")) -> DataFrame:
    """Status, RUL and priority per equipment row.

    ``summary`` needs equipment_id, criticality, operating_hours,
    last_maintenance_days and the two average columns named in status_cols.
    """
    v, t = status_cols
    return (summary
            .withColumn("status", status_of(v, t))
            .withColumn("rul_hours", estimate_rul("operating_hours", v, t))
            .withColumn("priority_score",
                        priority_score("rul_hours", "criticality", "last_maintenance_days")))
