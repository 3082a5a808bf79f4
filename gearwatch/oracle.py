"""DuckDB oracle SQL: the fixture mapping as CTEs plus one statement per query.

The driver pre-registers the raw tables as views; ``with_views`` prepends the
same equipment_master / sensor_readings mapping that
``gearwatch.sources.tables`` builds in Spark.  Dialect notes:
* all mapping arithmetic is DOUBLE (DuckDB reads ``1.0`` as DECIMAL);
* ``ROUND`` goes through DECIMAL(20,10) so ties round like Spark (on the
  shortest decimal text of the double, half-up);
* ``||`` instead of ``concat`` so a NULL part nulls the whole string.
"""

from __future__ import annotations

from . import config as C


def dbl(x) -> str:
    return f"CAST({x} AS DOUBLE)"


def rnd(expr: str, n: int) -> str:
    """Spark-compatible ROUND of a DOUBLE."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(20,10)), {n}) AS DOUBLE)"


def r6(expr: str) -> str:
    """Stddev-like columns are compared after ROUND(x, 6) on both sides."""
    return f"ROUND({expr}, 6)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def status_sql(v: str, t: str) -> str:
    return (f"CASE WHEN {v} > {C.VIBRATION_CRITICAL} OR {t} > {C.TEMPERATURE_CRITICAL} THEN {q(C.STATUS_CRITICAL)} "
            f"WHEN {v} > {C.VIBRATION_DANGER} OR {t} > {C.TEMPERATURE_DANGER} THEN {q(C.STATUS_DANGER)} "
            f"WHEN {v} > {C.VIBRATION_CAUTION} OR {t} > {C.TEMPERATURE_CAUTION} THEN {q(C.STATUS_CAUTION)} "
            f"ELSE {q(C.STATUS_NORMAL)} END")


def rul_sql(h: str, v: str, t: str, m: str = str(C.RUL_MAX_OPERATING_HOURS)) -> str:
    return (f"GREATEST({dbl(0)}, {dbl(m)} - {dbl(h)} - ({dbl(v)} * {C.RUL_VIBRATION_WEIGHT}) "
            f"- (GREATEST({dbl(t)} - {C.RUL_TEMPERATURE_BASE}, 0) * {C.RUL_TEMPERATURE_WEIGHT}))")


def priority_sql(r: str, crit: str, days: str) -> str:
    arms = " ".join(f"WHEN {q(g)} THEN {p}" for g, p in C.CRITICALITY_POINTS.items())
    return (f"LEAST({dbl(100)}, GREATEST({dbl(0)}, "
            f"(1 - {dbl(r)} / {dbl(C.PRIORITY_RUL_SCALE)}) * {C.PRIORITY_RUL_WEIGHT} + "
            f"CASE {crit} {arms} ELSE {C.CRITICALITY_POINTS_OTHER} END + "
            f"LEAST(CAST({days} AS INTEGER) / {dbl(C.PRIORITY_DAYS_DIVISOR)}, {dbl(C.PRIORITY_DAYS_CAP)})))")


def _grid(expr: str, steps: float) -> str:
    return f"FLOOR(({expr}) * {dbl(steps)}) / {dbl(steps)}"


_D = "(CAST(m.operating_hours AS DOUBLE) / CAST(15000.0 AS DOUBLE))"

MAPPING_CTES = f"""
equipment_master AS (
  SELECT 'EQ-' || lpad(CAST(s.s_suppkey AS VARCHAR), 6, '0') AS equipment_id,
         s.s_name AS equipment_name,
         n.n_name AS line,
         CASE s.s_nationkey % 4 WHEN 0 THEN {q(C.CRIT_CORE)} WHEN 1 THEN {q(C.CRIT_IMPORTANT)}
              WHEN 2 THEN {q(C.CRIT_AUXILIARY)} ELSE {q(C.CRIT_CORE)} END AS criticality,
         CAST(FLOOR((s.s_acctbal + {dbl(1000.0)}) * {dbl(1.5)}) AS INTEGER) AS operating_hours,
         s.s_suppkey AS _suppkey
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
),
sensor_readings AS (
  SELECT 'EQ-' || lpad(CAST(l.l_suppkey AS VARCHAR), 6, '0') AS equipment_id,
         TIMESTAMP '2024-01-01 00:00:00' + to_hours(CAST((l.l_orderkey * 7 + l.l_linenumber) % 1000 AS BIGINT)) AS "timestamp",
         CASE WHEN l.l_orderkey % 211 = 0 THEN {dbl(-1.0)}
              WHEN l.l_orderkey % 503 = 0 THEN CAST(NULL AS DOUBLE)
              ELSE {_grid(f"{dbl(2.0)} + {_D} * {dbl(8.0)} + (l.l_quantity - {dbl(25.0)}) / {dbl(12.5)}", 64.0)} END AS vibration_rms,
         CASE WHEN l.l_orderkey % 307 = 0 THEN {dbl(250.0)}
              WHEN l.l_orderkey % 509 = 0 THEN CAST(NULL AS DOUBLE)
              ELSE {_grid(f"{dbl(40.0)} + {_D} * {dbl(45.0)} + (l.l_discount - {dbl(0.05)}) * {dbl(200.0)}", 16.0)} END AS temperature_c,
         CASE WHEN l.l_orderkey % 401 = 0 THEN {dbl(-5.0)}
              ELSE {_grid(f"{dbl(100.0)} - {_D} * {dbl(40.0)} + (l.l_tax - {dbl(0.04)}) * {dbl(250.0)}", 16.0)} END AS pressure_bar,
         {_grid(f"{dbl(10.0)} + {_D} * {dbl(5.0)} + CAST(l.l_partkey % 17 - 8 AS DOUBLE) / {dbl(10.0)}", 64.0)} AS current_amp
  FROM lineitem l JOIN equipment_master m ON l.l_suppkey = m._suppkey
)"""


def with_views(body: str, ctes: str = "") -> str:
    """Prefix a statement with the mapping CTEs (and optional extra CTEs)."""
    body = body.strip()
    if body[:5].upper() == "WITH ":
        # merge the statement's own CTE list into ours
        body = "," + body[5:]
    else:
        body = "\n" + body
    extra = f",\n{ctes.strip()}" if ctes.strip() else ""
    return f"WITH {MAPPING_CTES.strip()}{extra}{body}"


AS_OF_TS = f"TIMESTAMP '{C.DEFAULT_AS_OF:%Y-%m-%d %H:%M:%S}'"
AS_OF_DATE = f"DATE '{C.DEFAULT_AS_OF:%Y-%m-%d}'"
RECENT_START = f"CAST({AS_OF_DATE} - INTERVAL 1 DAY AS DATE)"
