"""S3/S4 idempotency, S6/S7 round trip, S8/S10/S11."""

import json
import uuid


from gearwatch.session import scratch_path
from gearwatch.sources.catalog import data_dictionary, equipment_listing, publish_view, with_comments
from gearwatch.sources.documents import export_documents, read_document_files
from gearwatch.sources.sinks import append_batch, read_table


def test_append_is_idempotent_per_partition(spark):
    path = scratch_path(spark, "t_append")
    day1 = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-01")], "k string, date string")
    day2 = spark.createDataFrame([("c", "2024-01-02")], "k string, date string")
    append_batch(day1, path)
    append_batch(day2, path)
    append_batch(day1, path)  # rerun of day 1 replaces it, no duplicates
    assert sorted(r.k for r in read_table(spark, path).collect()) == ["a", "b", "c"]


def test_document_round_trip_keeps_odd_documents(spark):
    docs = [("DOC-001", "CNC 선반 정비 가이드", "첫 줄\n둘째 줄"), ("DOC-002", "프레스기 안전 점검", ""), ("DOC-003", "no text", None),
            ("KB_001", "a_b c", "x"), ("KB_002", None, "y"), ("KB_003", None, "z"), ("KB_004", "in/out", "w")]
    path = scratch_path(spark, "t_docs")
    given = spark.createDataFrame(docs, "doc_id string, title string, content string")
    for _ in range(2):  # a rerun replaces
        export_documents(given, path)
        assert sorted(map(tuple, read_document_files(spark, path).collect()), key=lambda r: r[0]) == docs


ODD = [("a", "b_c", "X"), ("a_b", "c", "Y"), ("a b", "c", "Z"), ("a", "b c", "W"), ("a%5Fb", "c", "V"), ("a/b", "c", "U"), ("", "", "T"),
       (None, None, "S"), ("%N", "%N", "R"), ("l", "long title " * 60, "Q"), ("l", "long title " * 61, "P"), ("é 1", "ü\nx", "O"), (".h", "d", "N"), ("%E", "", "M"),
       ("same", "title", "one"), ("same", "title", "two"), ("same", "title", "two"), ("same", "title", None), ("same", "title", "")]


def test_documents_with_confusable_names_round_trip(spark):
    path = scratch_path(spark, "t_docs")
    export_documents(spark.createDataFrame(ODD, "doc_id string, title string, content string"), path)
    back = [tuple(r) for r in read_document_files(spark, path).collect()]
    assert sorted(back, key=repr) == sorted(ODD, key=repr)


def test_names_of_plain_documents_are_plain_and_names_can_be_read_back(spark):
    from gearwatch.sources.documents import file_name_of, parsed_name
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([r[:2] for r in ODD[:9]] + [("DOC-001", "CNC 선반 정비")], "doc_id string, title string").distinct()
    named = rows.select("doc_id", "title", file_name_of().alias("f"))
    back = named.select("doc_id", "title", *[c.alias(n) for c, n in zip(parsed_name(F.col("f")), ("i", "t"), strict=True)], "f").collect()
    assert {r.f for r in back if r.doc_id == "DOC-001"} == {"DOC-001_CNC_선반_정비.txt"}
    # an underscore in a name is a space of the title
    assert len({r.f for r in back}) == 10 and all((r.i, r.t and r.t.replace("_", " ")) == (r.doc_id, r.title and r.title.replace("_", " ")) for r in back)


def test_a_new_export_replaces_the_old_one_whole(spark):
    from gearwatch.sources.documents import drop_old_exports
    path = scratch_path(spark, "t_docs")
    docs = lambda *r: spark.createDataFrame(list(r), "doc_id string, title string, content string")
    export_documents(docs(("1", "a", "x"), ("2", "b", "y")), path)
    export_documents(docs(("2", "b", "new")), path)
    assert [tuple(r) for r in read_document_files(spark, path).collect()] == [("2", "b", "new")]
    assert drop_old_exports(spark, path) == 1
    assert [tuple(r) for r in read_document_files(spark, path).collect()] == [("2", "b", "new")]


def test_document_files_without_manifest(spark, tmp_path):
    (tmp_path / "DOC-001_safety_check.txt").write_text("text")
    back = read_document_files(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in back] == [("DOC-001", "safety_check", "text")]  # plain names are taken as they are


def test_listing_and_dictionary(spark, equip):
    rec = json.loads(equipment_listing(equip).first().record)
    assert set(rec) == {"equipment_id", "equipment_name", "line", "criticality", "operating_hours"}
    commented = with_comments(equip, {"operating_hours": "total operating hours"})
    dd = data_dictionary(spark, {"equipment_master": commented}, {"equipment_master": "master data"})
    rows = {(r.column): r.comment for r in dd.collect()}
    assert rows[None] == "master data" and rows["operating_hours"] == "total operating hours"


def test_publish_view_replaces(spark):
    publish_view(spark, "gw_tmp_view", spark.range(3))
    publish_view(spark, "gw_tmp_view", spark.range(5))
    assert spark.table("gw_tmp_view").count() == 5


def test_daily_run_rerun_does_not_duplicate(spark, readings, equip):
    import datetime as dt

    from gearwatch.operators.alerts import daily_run
    from gearwatch.operators.readings import reading_date
    base = scratch_path(spark, "t_daily")
    store = append_batch(reading_date(readings), f"{base}/store")
    day = dt.date(2024, 2, 2)
    paths = daily_run(spark, store, readings, equip, day, base)
    first = sorted(tuple(r) for r in read_table(spark, paths["alerts"]).collect())
    stored = read_table(spark, paths["readings"]).count()
    daily_run(spark, store, readings, equip, day, base)  # rerun of the same day
    assert sorted(tuple(r) for r in read_table(spark, paths["alerts"]).collect()) == first
    assert read_table(spark, paths["readings"]).count() == stored == readings.count()


def test_append_to_a_table_keeps_other_days_and_batches(spark):
    name = f"gw_append_{uuid.uuid4().hex[:8]}"
    rows = lambda *r: spark.createDataFrame(list(r), "k string, date string")
    append_batch(rows(("a", "2024-01-01")), name, batch_id="morning")
    append_batch(rows(("b", "2024-01-01")), name, batch_id="evening")
    append_batch(rows(("c", "2024-01-02")), name, batch_id="morning")
    append_batch(rows(("c", "2024-01-02")), name, batch_id="morning")  # rerun
    assert sorted(r.k for r in spark.table(name).collect()) == ["a", "b", "c"]
    spark.sql(f"DROP TABLE {name}")


def test_inference_log_keeps_every_run(spark):
    from pyspark.sql import functions as F

    from gearwatch.sources.ledger import read_runs
    from gearwatch.sources.sinks import inference_log
    path = scratch_path(spark, "t_log")
    scored = spark.createDataFrame([("EQ-1", 1.0, 2.0)], "equipment_id string, x double, prediction double")
    at = F.lit("2024-02-02 12:00:00").cast("timestamp")
    for model, run in (("m1", None), ("m2", None), ("m1", None), ("m1", "retried"), ("m1", "retried")):
        inference_log(scored, ["x"], model, at, path, run_id=run)
    rows = read_runs(spark, path).collect()
    assert sorted(r.model_id for r in rows) == ["m1", "m1", "m1", "m2"] and len({r.run_id for r in rows}) == 4


def test_a_retry_replaces_its_run_alone_and_a_dead_run_is_not_seen(spark):
    from gearwatch.sources.ledger import append_run, committed, read_runs, vacuum
    path = scratch_path(spark, "t_ledger")
    rows = lambda *r: spark.createDataFrame(list(r), "k string, date string")
    append_run(rows(("a", "2024-01-01"), ("b", "2024-01-02")), path, "file 1/2")
    append_run(rows(("c", "2024-01-01")), path, "file 2/2")
    append_run(rows(("d", "2024-01-01")), path, "file 1/2")                     # the retry holds no second day any more
    rows(("x", "2024-01-01")).write.partitionBy("date").parquet(f"{path}/runs/attempt=adead")  # died before its commit
    got = sorted((r.k, str(r.date), r.run_id) for r in read_runs(spark, path).collect())
    assert got == [("c", "2024-01-01", "file 2/2"), ("d", "2024-01-01", "file 1/2")]
    assert [r.k for r in read_runs(spark, path, ["file 2/2"]).collect()] == ["c"]
    assert vacuum(spark, path) == 2 and vacuum(spark, path) == 0                # the dead and the replaced attempt
    assert sorted(r.k for r in read_runs(spark, path).collect()) == ["c", "d"] and len(committed(spark, path)) == 2


def test_two_files_of_a_day_are_both_kept(spark, readings, equip):
    import datetime as dt

    from pyspark.sql import functions as F

    from gearwatch.operators.alerts import daily_run
    from gearwatch.operators.readings import reading_date
    from gearwatch.sources.ledger import append_run, read_runs
    base, day = scratch_path(spark, "t_files"), dt.date(2024, 2, 2)
    store = append_run(reading_date(readings).where(F.col("date") != F.lit(day)), f"{base}/store", "history")
    halves = [readings.where(F.hour("timestamp") < 9), readings.where(F.hour("timestamp") >= 9)]
    for run, part in (("am", halves[0]), ("pm", halves[1]), ("am", halves[0])):
        paths = daily_run(spark, store, part, equip, day, base, run_id=run)
    assert read_runs(spark, store).count() == readings.count()
    # the second file's run and the repeated first run have seen the whole day
    whole = daily_run(spark, append_batch(reading_date(readings), f"{base}/plain"), readings, equip, day, f"{base}/other")
    want = sorted(tuple(r)[:4] for r in read_table(spark, whole["alerts"]).collect())
    for run in ("am", "pm"):
        assert sorted(tuple(r)[:4] for r in read_runs(spark, paths["alerts"], [run]).collect()) == want


def test_cluster_without_shared_folder_is_an_error():
    from gearwatch.session import local_master
    assert local_master("local[4]") and local_master("local")
    assert not local_master("local-cluster[3,2,1024]") and not local_master("spark://host:7077") and not local_master("yarn")
