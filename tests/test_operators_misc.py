"""D1 warn/fail rules, P11, A6 empty-group semantics, S10 table comments."""

import pytest
from pyspark.sql import functions as F

from gearwatch.operators.quality import DROP, FAIL, WARN, Rule, check_failures, expect, expect_or_drop
from gearwatch.operators.readings import project_columns
from gearwatch.session import scratch_path
from gearwatch.sources.catalog import comment_on_table, set_table_properties


def test_expect_keeps_rows_and_counts(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "pressure_bar double")
    kept, obs = expect(df, [Rule("p", "pressure_bar > 0", WARN)])
    assert kept.count() == 3 and obs.get["p"] == 2


def test_fail_rule_raises(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,)], "x double")
    rules = [Rule("pos", "x > 0", FAIL), Rule("drop_neg", "x > 0", DROP)]
    kept, obs = expect_or_drop(df, rules)
    assert kept.count() == 1
    with pytest.raises(ValueError, match="pos"):
        check_failures(obs, rules)


def test_project_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert project_columns(df, {"x": "b"}).columns == ["x"]
    assert project_columns(df, ["b", "a"]).columns == ["b", "a"]


def test_conditional_count_forms_on_empty_group(spark):
    df = spark.createDataFrame([("k", 1.0)], "k string, v double").where(F.col("v") > 5)
    row = df.agg(F.sum(F.when(F.col("v") > 0, 1).otherwise(0)).alias("s"),
                 F.count_if(F.col("v") > 0).alias("c")).first()
    assert row.s is None and row.c == 0   # SUM(CASE) is NULL, COUNT FILTER is 0


def test_comment_on_table(spark):
    path = scratch_path(spark, "t_comment")
    spark.range(3).write.mode("overwrite").parquet(path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS gw_commented USING parquet LOCATION '{path}'")
    comment_on_table(spark, "gw_commented", "장비 마스터 데이터's comment")
    rows = spark.sql("DESCRIBE TABLE EXTENDED gw_commented").collect()
    assert any(r.col_name == "Comment" and "장비 마스터" in r.data_type for r in rows)
    set_table_properties(spark, "gw_commented", {"quality": "bronze"})
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES gw_commented").collect()}
    assert props["quality"] == "bronze"
    spark.sql("DROP TABLE gw_commented")


def test_published_layers_keep_their_comments_in_the_catalog(spark, readings):
    from gearwatch import config as C
    from gearwatch.operators.medallion import build_bronze
    from gearwatch.sources.catalog import catalog_dictionary, publish_layers, publish_table
    bronze = build_bronze(readings).limit(5)
    names = publish_layers(spark, {"bronze": bronze, "gold": bronze}, "gw_layer_")
    told = publish_table(spark, "gw_told", bronze, "it's told", {"current_amp": "평균 전류 (A)"})
    try:
        rows = catalog_dictionary(spark, [*names.values(), told]).collect()
        at = {(r["table"], r["column"]): r for r in rows}
        assert at["gw_layer_bronze", None]["comment"] == C.LAYER_COMMENTS["bronze"]
        assert (at["gw_layer_bronze", None]["quality"], at["gw_layer_gold", "source"]["quality"]) == ("bronze", "gold")
        assert at["gw_told", "current_amp"]["comment"] == "평균 전류 (A)" and at["gw_told", "source"]["comment"] is None
        assert at["gw_told", None]["comment"] == "it's told" and at["gw_told", None]["quality"] is None
        assert len(rows) == 3 * (1 + len(bronze.columns))
    finally:
        for name in [*names.values(), told]:
            spark.sql(f"DROP TABLE {name}")


def test_functions_are_described(spark):
    from gearwatch import config as C
    from gearwatch.functions.health import register_sql_functions
    for name in register_sql_functions(spark):
        told = "".join(r[0] for r in spark.sql(f"DESCRIBE FUNCTION EXTENDED {name}").collect())
        assert C.FUNCTION_COMMENTS[name] in told


def test_masks_give_the_report_and_the_rows_of_any_choice_of_rules(spark):
    from gearwatch.operators import quality as Q
    rows = [(None, 20.0, 1.0), (60.0, None, None), (5.0, 20.0, -1.0), (5.0, 20.0, 1.0), (5.0, 20.0, 1.0), (0.0, 300.0, 0.0)]
    df = spark.createDataFrame(rows, "vibration_rms double, temperature_c double, pressure_bar double")
    marked = Q.marked(df)
    assert sorted(r["failed_rules"] for r in marked.collect()) == [0, 0, 1, 4, 7, 7]
    report = lambda d: sorted(map(tuple, d.collect()))
    assert report(Q.report_of_masks(Q.mask_counts(marked))) == report(Q.quality_report(df))
    assert report(Q.report_of_masks(Q.mask_counts(marked.limit(0)))) == report(Q.quality_report(df.limit(0)))
    names = [r.name for r in Q.SILVER_RULES]
    assert [Q.passing(marked, names[:k]).count() for k in range(4)] == [6, 3, 3, 2]
    kept, _ = Q.expect_or_drop(df, Q.SILVER_RULES, name="masks")
    assert Q.passing(marked, names[:2]).drop("failed_rules").exceptAll(kept).count() == 0
