"""Listing, data dictionary and view publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import config as C
from .sinks import write_snapshot


def equipment_listing(equip: DataFrame) -> DataFrame:
    """Every master row as a name -> value JSON record (the app's list endpoint)."""
    return equip.select("equipment_id", F.to_json(F.struct(*equip.columns)).alias("record"))


def publish_view(spark: SparkSession, name: str, df: DataFrame, replace_global: bool = False) -> str:
    """Idempotent view replacement (drop if exists, create or replace)."""
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    if replace_global:
        df.createOrReplaceGlobalTempView(name)
    else:
        df.createOrReplaceTempView(name)
    return name


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments as StructField metadata (travels with the schema)."""
    cols = []
    for f in df.schema.fields:
        if f.name in comments:
            cols.append(F.col(f.name).alias(f.name, metadata={**(f.metadata or {}), "comment": comments[f.name]}))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def comment_on_table(spark: SparkSession, table: str, comment: str) -> None:
    """``COMMENT ON TABLE`` for a catalog table."""
    spark.sql(f"COMMENT ON TABLE {table} IS '{comment.replace(chr(39), chr(39) * 2)}'")


def set_table_properties(spark: SparkSession, table: str, props: dict[str, str]) -> None:
    """Table properties, e.g. the medallion layer tag ``quality=bronze``."""
    kv = ", ".join(f"'{k}' = '{v}'" for k, v in props.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({kv})")


def publish_table(spark: SparkSession, name: str, df: DataFrame, comment: str = "",
                  comments: dict[str, str] | None = None, properties: dict[str, str] | None = None,
                  partition_by=None) -> str:
    """``df`` as catalog table ``name`` (replaced whole) with its comments and properties kept in the catalog."""
    write_snapshot(with_comments(df, comments or {}), name, partition_by)
    if comment:
        comment_on_table(spark, name, comment)
    if properties:
        set_table_properties(spark, name, properties)
    return name


def publish_layers(spark: SparkSession, layers: dict[str, DataFrame], prefix: str = "") -> dict[str, str]:
    """The medallion layers as catalog tables, described and tagged with their layer (``quality``).

    ``layers`` maps bronze, silver, gold, recommendations to a written table or a lazy one; all or some.
    """
    return {layer: publish_table(spark, f"{prefix}{layer}", df, C.LAYER_COMMENTS[layer],
                                 properties={"quality": C.LAYER_QUALITY[layer]}) for layer, df in layers.items()}


def catalog_dictionary(spark: SparkSession, tables: list[str]) -> DataFrame:
    """(table, column, type, comment, quality) as the catalog holds them, a row per table and per column.

    Reads the catalog only, as many rows as the tables have columns.  Tables and columns
    without a comment have null there; ``quality`` is the layer tag of the table, null where it has none.
    """
    rows = []
    for name in tables:
        tags = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        layer = tags.get("quality")
        rows.append((name, None, None, spark.catalog.getTable(name).description or None, layer))
        rows += [(name, c.name, c.dataType, c.description or None, layer) for c in spark.catalog.listColumns(name)]
    schema = StructType([StructField(n, StringType()) for n in ("table", "column", "type", "comment", "quality")])
    return spark.createDataFrame(rows, schema)


def data_dictionary(spark: SparkSession, tables: dict[str, DataFrame],
                    table_comments: dict[str, str] | None = None) -> DataFrame:
    """(table, column, type, comment) rows from the schemas' metadata.

    Reads schemas only (driver-side metadata, bounded by column count), never
    table data.
    """
    table_comments = table_comments or {}
    rows = []
    for tname, df in tables.items():
        rows.append((tname, None, None, table_comments.get(tname)))
        for f in df.schema.fields:
            rows.append((tname, f.name, f.dataType.simpleString(), (f.metadata or {}).get("comment")))
    schema = StructType([StructField(n, StringType()) for n in ("table", "column", "type", "comment")])
    return spark.createDataFrame(rows, schema)


def metric_dictionary(spark: SparkSession, views) -> DataFrame:
    """S10 for metric views: (view, kind, name, comment) for each view, its
    dimensions and its measures (metadata only, no table data)."""
    rows = [r for v in views for r in v.describe()]
    schema = StructType([StructField(n, StringType()) for n in ("view", "kind", "name", "comment")])
    return spark.createDataFrame(rows, schema)
