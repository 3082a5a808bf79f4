"""Property test: Column builders == SQL functions == a plain-Python statement
of the rules, on random inputs including NULLs and exact thresholds."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gearwatch import config as C
from gearwatch.functions.health import estimate_rul, priority_score, register_sql_functions, status_of

EDGES = [4.5, 7.0, 10.0, 60.0, 75.0, 90.0, 0.0, -1.0]
num = st.one_of(st.none(), st.sampled_from(EDGES),
                st.floats(min_value=-50, max_value=300, allow_nan=False).map(lambda x: round(x, 3)))
crit = st.one_of(st.none(), st.sampled_from([C.CRIT_CORE, C.CRIT_IMPORTANT, C.CRIT_AUXILIARY, "기타"]))
days = st.one_of(st.none(), st.integers(min_value=0, max_value=2000))


def py_status(v, t):
    def gt(x, th):
        return x is not None and x > th
    if gt(v, C.VIBRATION_CRITICAL) or gt(t, C.TEMPERATURE_CRITICAL):
        return C.STATUS_CRITICAL
    if gt(v, C.VIBRATION_DANGER) or gt(t, C.TEMPERATURE_DANGER):
        return C.STATUS_DANGER
    if gt(v, C.VIBRATION_CAUTION) or gt(t, C.TEMPERATURE_CAUTION):
        return C.STATUS_CAUTION
    return C.STATUS_NORMAL


def py_rul(h, v, t):
    # GREATEST skips NULL at both levels: a NULL temperature adds no penalty,
    # a NULL hours or vibration makes the outer expression NULL -> 0.0
    penalty = 0.0 if t is None else max(t - 50, 0)
    if h is None or v is None:
        return 0.0
    return max(0.0, 10000.0 - h - v * 50 - penalty * 30)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(num, num, num, crit, days), min_size=50, max_size=80))
def test_builders_sql_and_python_agree(spark, rows):
    register_sql_functions(spark)
    df = spark.createDataFrame(rows, "v double, t double, h double, c string, d int")
    out = df.select("v", "t", "h", "c", "d",
                    status_of("v", "t").alias("s1"),
                    estimate_rul("h", "v", "t").alias("r1"),
                    priority_score(estimate_rul("h", "v", "t"), "c", "d").alias("p1")) \
        .selectExpr("*", "assess_vibration_status(v, t) AS s2", "estimate_rul(h, v, t) AS r2",
                    "maintenance_priority_score(estimate_rul(h, v, t), c, d) AS p2").collect()
    for r in out:
        assert r.s1 == r.s2 == py_status(r.v, r.t)
        assert r.r1 == r.r2
        assert abs(r.r1 - py_rul(r.h, r.v, r.t)) < 1e-6
        assert abs(r.p1 - r.p2) < 1e-9 and 0.0 <= r.p1 <= 100.0
