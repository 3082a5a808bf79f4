"""Knowledge documents as a table and as a folder of text files."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root, local_master
from .sinks import hadoop_path, path_exists, read_table, replace_file, write_snapshot

#: Beside the text files of an export: what their names cannot say.  Spark's file sources skip it.
MANIFEST = "_manifest"
#: In the export's folder: which export counts.
CURRENT = "current.json"
NAME_CHARS = 180         # of a file name; longer ones end in a digest


def knowledge_base(docs: DataFrame) -> DataFrame:
    """K1: the knowledge table: doc_id, title, content (all strings)."""
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"),
                       F.col("title").cast("string").alias("title"),
                       F.col("content").cast("string").alias("content"))


def _escaped(name: str, marks: str) -> Column:
    """The text with each of ``marks`` as ``%XX``; NULL is ``%N``, which no text gives."""
    out = F.col(name).cast("string")
    for c in "%" + marks:
        out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return F.coalesce(out, F.lit("%N"))


def file_name_of(doc_id="doc_id", title="title") -> Column:
    """``{doc_id}_{title with spaces -> _}.txt``, made reversible.

    What the plain form would confuse is escaped: ``_`` and ``/`` in id and title, spaces in ids,
    ``%`` itself, a leading ``.`` and an empty id; so different (id, title) have different names, and names of plain ids and
    titles are the plain form.  Names beyond ``NAME_CHARS`` are cut and end in a digest.
    """
    odd = "_/\\\t\n\r"
    first = F.regexp_replace(_escaped(doc_id, odd + " "), r"^\.", "%2E")  # Spark skips files that begin with . or _
    first = F.when(first == "", F.lit("%E")).otherwise(first)
    whole = F.concat(first, F.lit("_"), F.translate(_escaped(title, odd), " ", "_"))
    cut = F.concat(F.substring(whole, 1, NAME_CHARS // 4), F.lit("%~"), F.substring(F.sha2(whole.cast("binary"), 256), 1, 32))
    return F.concat(F.when(F.octet_length(whole) > NAME_CHARS, cut).otherwise(whole), F.lit(".txt"))


def parsed_name(file_name: Column) -> tuple[Column, Column]:
    """(doc_id, title) of a file name: what ``file_name_of`` escaped, and plain names as they are."""
    def plain(part: Column) -> Column:
        out = part
        for c in "_/\\\t\n\r .%":
            out = F.replace(out, F.lit(f"%{ord(c):02X}"), F.lit(c))
        return F.when(part == "%E", F.lit("")).when(part != "%N", out)

    parts = [F.regexp_extract(file_name, r"^([^_]*)_(.*)\.txt$", k) for k in (1, 2)]
    return plain(parts[0]), plain(parts[1])


def shared_folder(spark: SparkSession, path: str) -> str:
    """``path`` with its filesystem; on a cluster a worker's own disk is an error."""
    sc = spark.sparkContext

    def full(name: str) -> str:
        p = sc._jvm.org.apache.hadoop.fs.Path(name)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(p).toString()

    target = full(path)
    if target.startswith("file:") and not local_master(sc.master) and not target.startswith(full(checkpoint_root(spark))):
        raise ValueError(f"{target} is a folder of each worker; name one that the executors of {sc.master} share")
    return target


def _write_partition(base: str):
    def run(rows):
        from pyarrow import fs as pafs
        if "://" in base:
            filesystem, root = pafs.FileSystem.from_uri(base)
        else:
            filesystem, root = pafs.LocalFileSystem(), base[5:] if base.startswith("file:") else base
        filesystem.create_dir(root, recursive=True)
        for r in rows:
            with filesystem.open_output_stream(f"{root}/{r['file_name']}") as out:
                out.write((r["content"] or "").encode("utf-8"))
    return run


def with_names(docs: DataFrame) -> DataFrame:
    """``docs`` with ``file_name``, different for different documents.

    Different contents under one (id, title) get the content's digest into their names; equal
    rows are one document and share a file.
    """
    named = docs.select(file_name_of().alias("_name"), F.sha2(F.coalesce(F.concat(F.lit("="), F.col("content")), F.lit("")).cast("binary"), 256)
                        .alias("_digest"), "doc_id", "title", "content")
    shared = (named.groupBy("_name").agg(F.min("_digest").alias("lo"), F.max("_digest").alias("hi")).where("lo != hi")
              .select("_name", F.lit(True).alias("_shared")))
    own = F.concat(F.regexp_replace("_name", r"\.txt$", ""), F.lit("%~"), F.substring("_digest", 1, 32), F.lit(".txt"))
    return (named.join(shared, "_name", "left").withColumn("file_name", F.when(F.col("_shared"), own).otherwise(F.col("_name")))
            .drop("_name", "_digest", "_shared"))


def export_documents(docs: DataFrame, path: str) -> str:
    """One text file per document, written by the executors in parallel.

    Each export writes a folder of its own below ``path`` - the files, straight from the tasks (any
    filesystem pyarrow can open), then a manifest of the documents with their true ids and titles,
    NULLs included - and only then is it named as the current one, by an atomic rename.  A document that
    is no longer exported is gone with the old folder's standing, and an export that dies half-way changes nothing.
    """
    spark = docs.sparkSession
    version = f"export-{uuid.uuid4().hex}"
    named = with_names(docs)
    named.select("file_name", "content").foreachPartition(_write_partition(shared_folder(spark, f"{path}/{version}")))
    write_snapshot(named.select("file_name", "doc_id", "title", F.col("content").isNull().alias("no_content")),
                   f"{path}/{version}/{MANIFEST}")
    replace_file(spark, f"{path}/{CURRENT}", json.dumps({"version": version}) + "\n")
    return path


def current_export(spark: SparkSession, path: str) -> str | None:
    """The folder of the export that counts, if ``path`` holds any."""
    if not path_exists(spark, f"{path}/{CURRENT}"):
        return None
    return f"{path}/{spark.read.schema('version string').json(f'{path}/{CURRENT}').first()['version']}"


def drop_old_exports(spark: SparkSession, path: str) -> int:
    """Remove the folders of exports that no longer count; how many went."""
    now = current_export(spark, path)
    folder, fs = hadoop_path(spark, path)
    old = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("export-")
           and now is not None and not now.endswith("/" + s.getPath().getName())]
    for p in old:
        fs.delete(p, True)
    return len(old)


def read_document_files(spark: SparkSession, path: str) -> DataFrame:
    """A folder of ``*.txt`` files as (doc_id, title, content).

    ``binaryFile`` yields one row per file with its whole contents and the
    UTF-8 decode runs in the JVM.  Of a folder of exports the current one is read: every listed document, with
    id, title and NULL content from the manifest (Spark's file sources skip zero-byte files, so
    a listed document without a file row is empty).  A plain folder is read by the files' names: the id ends at the first ``_``.
    """
    export = current_export(spark, path)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(export or path)
             .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                     F.decode("content", "UTF-8").alias("text")))
    if export is None:
        doc_id, title = parsed_name(F.col("file_name"))
        return files.select(doc_id.alias("doc_id"), title.alias("title"), F.col("text").alias("content"))
    listed = read_table(spark, f"{export}/{MANIFEST}").join(files, "file_name", "left")
    content = F.when(~F.col("no_content"), F.coalesce("text", F.lit("")))
    return listed.select("doc_id", "title", content.alias("content"))
