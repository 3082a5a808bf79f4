"""Small folders of tables for running the registered queries on."""

import __spark_entry__

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CONVERSATIONS = "conv_id long, turn long, role string, text string"
LABELS = "doc_id long, quality int, toxic int"
#: Columns whose names operators might use themselves.
CLASHING = "id long, _id long, _row long, _key string, _spans string, h long, at long, n long, grp string, conv long, x double, label int, src string, size long"


def folder(spark, tmp_path, clash=False, **tables):
    """A folder with the tables (rows, schema); with ``clash`` each has further columns of awkward names, all filled."""
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        if clash:
            for c in CLASHING.split(", "):
                key, kind = c.split()
                df = df.selectExpr("*", f"cast('7' as {kind}) as `{key}`") if key not in df.columns else df
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def run(spark, name, path):
    return __spark_entry__.queries()[name](spark, path)


def documents(rows):
    """Rows (doc_id, text, lang, source) with their n_chars."""
    return [(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows], DOCUMENTS
