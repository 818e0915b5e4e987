"""Files in and out: scanning a tree, hashing, mapping paths, publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_pdfs(spark: SparkSession, folder: str, content: bool = True) -> DataFrame:
    """(path, modificationTime, length[, content]) of the PDF files under a folder, the suffix in any case.

    A folder that doesn't exist fails; an empty one gives an empty result. Without content no file is opened.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][dD][fF]").load(folder)
    return rows if content else rows.drop("content")


def in_order(files: DataFrame) -> DataFrame:
    """Files by path, whatever the case of its letters; equal ones by their exact path."""
    return files.orderBy(F.lower("path"), "path")


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def output_path(path: Column, source: str, target: str, suffix: str) -> Column:
    """The place of a file's output: its place under source, under target with another suffix; null outside source."""
    rest = F.regexp_replace(F.substr(path, F.lit(len(source) + 1)), r"\.[^./]*$", "")
    return F.when(path.startswith(source), F.concat(F.lit(target), rest, F.lit(suffix)))


def failed_path(path: Column, source: str, target: str) -> Column:
    return F.when(path.startswith(source), F.concat(F.lit(target), F.substr(path, F.lit(len(source) + 1))))


def embedded_name(parent: Column, idx: Column, name: Column) -> Column:
    """The place of an attachment's output beside its parent's."""
    safe = F.regexp_replace(F.regexp_replace(name, r"^.*[/\\]", ""), r"(?i)\.pdf$", "")
    return F.format_string("%s.embedded/%04d-%s.pdf", parent, idx, F.when(safe == "", "attachment").otherwise(safe))


def is_pdf(name: Column, content: Column) -> Column:
    """Whether an attachment is a PDF, by its name or by the mark within its first 1024 bytes."""
    return F.lower(name).endswith(".pdf") | (F.instr(F.substring(content, 1, 1024).cast("string"), "%PDF-") > 0)


def read_sidecars(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Published JSON sidecars with the text beside each: (stem, columns of schema, text); unreadable JSON gives nulls, a missing text null."""
    stem = lambda suffix: F.regexp_replace(F.col("_metadata.file_path"), suffix, "")
    read = lambda glob: spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(folder)
    meta = read("*.json").select(stem(r"\.json$").alias("stem"), F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("m"))
    texts = read("*.txt").where(~F.col("_metadata.file_path").endswith(".cleaned.txt")).select(stem(r"\.txt$").alias("stem"), F.col("value").alias("text"))
    return meta.join(texts, "stem", "left").select("stem", "m.*", "text")


def publish(rows: DataFrame, folder: str) -> None:
    """Write each row (path, body) as a file under a shared folder, by a temporary name that is then replaced, so that no reader sees half a file.

    body is a text or bytes; where it is null, a file of that name is removed, if there is one. A task that is run again
    does the same. The folder must be one that all executors see, as a mounted path or with the scheme file.
    """
    if "://" in folder and not folder.startswith("file://"):
        raise ValueError(f"{folder} isn't a mounted folder")
    folder = folder.removeprefix("file://")

    def write(part) -> None:
        import contextlib
        import os
        import tempfile

        for r in part:
            to = os.path.join(folder, r["path"])
            if r["body"] is None:
                with contextlib.suppress(OSError):
                    os.unlink(to)
                continue
            os.makedirs(os.path.dirname(to), exist_ok=True)
            handle, temp = tempfile.mkstemp(dir=os.path.dirname(to))
            try:
                with os.fdopen(handle, "wb") as f:
                    f.write(r["body"].encode() if isinstance(r["body"], str) else bytes(r["body"]))
                    f.flush()
                    os.fsync(f.fileno())
                os.replace(temp, to)
            except BaseException:
                with contextlib.suppress(OSError):
                    os.unlink(temp)
                raise

    rows.select("path", "body").foreachPartition(write)
