"""Folders of files as tables, and tables as folders of files."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..functions.scalars import col
from ..operators.sampling import head
from ..session import BATCH_BYTES, BATCH_ROWS, qualified


def _open_folder(folder: str):
    """(pyarrow file system, path inside it) of a full URI, as ``session.qualified`` gives it."""
    import re

    from pyarrow import fs

    if folder.startswith("file:"):  # names may hold characters that a URI does not
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", folder)
    return fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


_LISTED = "path string, is_folder boolean, last_modified timestamp, size bigint"


def _lister(folder: str, recursive: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, root = _open_folder(folder)
        for batch in batches:
            for start in batch["path"]:
                found = system.get_file_info(fs.FileSelector(root + start, recursive=recursive))
                for at in range(0, len(found), 10_000):
                    rows = [(i.path[len(root):], i.type == fs.FileType.Directory, i.mtime, i.size) for i in found[at:at + 10_000]]
                    out = pd.DataFrame(rows, columns=["path", "is_folder", "last_modified", "size"])
                    out["last_modified"] = pd.to_datetime(out["last_modified"], utc=True)
                    yield out

    return run


def list_folder(spark: SparkSession, folder: str, pattern: str = "") -> DataFrame:
    """path (from the folder on, with a leading slash), basename, extension, last_modified and
    size of every file below a folder whose name matches a regular expression.

    Subfolders of the first level are listed in parallel. File scans leave empty files out, so
    the listing asks the file system itself; no file is opened. A path without scheme is on the
    cluster's default file system, as everywhere in Spark.
    """
    folder = qualified(spark, folder.rstrip("/"))
    top = spark.createDataFrame([("",)], "path string").mapInPandas(_lister(folder, False), _LISTED)
    folders = top.filter("is_folder").select("path").repartition(spark.sparkContext.defaultParallelism)
    every = top.unionByName(folders.mapInPandas(_lister(folder, True), _LISTED))
    name = paths.file_name("path")
    return every.filter(~F.col("is_folder") & name.rlike(pattern or ".")).select(
        "path", name.alias("basename"), paths.extension(name).alias("extension"), "last_modified", "size"
    )


def with_extension(listing: DataFrame, ext: str, contains: str | None = None, path: str = "path") -> DataFrame:
    """Files of one extension, any case, sorted by path; optionally with a text in the name."""
    keep = listing.filter(paths.has_extension(path, ext))
    if contains:
        keep = keep.filter(F.lower(col(path)).contains(contains.lower()))
    return keep.orderBy(path)


# Names that file scans leave out, files and folders.
_HIDDEN = r"/\.|/_(?!common_metadata|metadata)[^/=]*(/|$)|\._COPYING_(/|$)"


def _contents(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open_folder(folder)
        names, bodies, size = [], [], 0
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with system.open_input_stream(root + path, compression=None) as source:
                    bodies.append(source.read())
                names.append(path)
                size += len(bodies[-1])
                if size >= BATCH_BYTES or len(names) >= BATCH_ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bodies, pa.binary())], names=["path", "content"])
                    names, bodies, size = [], [], 0
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(bodies, pa.binary())], names=["path", "content"])

    return run


def read_texts(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """One row per file: its path below the folder, its whole UTF-8 text and an error.

    Files are listed and read in tasks, each as one value: a scan would gather the status of every
    file in the driver, give a task about thirty files however small they are, and leave empty ones
    out. As in a scan, files with hidden names are left out unless they are empty. Bytes that are
    not UTF-8 become replacement characters and are reported in ``error``; they never fail the job.
    """
    folder = folder.rstrip("/")
    # the file names that Spark's pathGlobFilter takes
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    found = list_folder(spark, folder, f"(?s)^(?:{pattern})$").filter((F.col("size") == 0) | ~F.rlike("path", F.lit(_HIDDEN))).select("path")
    # a number of its own, as paths are too short to tell how much is read
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    read = found.repartition(tasks, "path").mapInArrow(_contents(qualified(spark, folder)), "path string, content binary")
    raw = F.col("content").cast("string")
    error = F.when(~F.is_valid_utf8(raw), F.lit("not UTF-8"))
    return read.select("path", F.make_valid_utf8(raw).alias("text"), error.alias("error"))


def read_lines(spark: SparkSession, path: str, column: str = "Title") -> DataFrame:
    """One row per line, compressed files included."""
    return spark.read.text(path).withColumnRenamed("value", column)


def save_table(df: DataFrame, path: str, rows_per_file: int | None = None) -> DataFrame:
    """Overwrite a Parquet table and return it as read back.

    ``rows_per_file`` bounds the size of each output file; every task writes its own files and
    the commit protocol keeps a lost or repeated task from leaving partial output.
    """
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_one_file_per_row(df: DataFrame, folder: str, name: str, text: str, suffix: str = ".md", folders: int = 0) -> DataFrame:
    """Write ``<folder>/<name><suffix>`` for every row, in parallel; returns (path, size).

    A folder of millions of files is slow to write to and is listed by one task; with ``folders``
    the files are spread over that many subfolders by a hash of their names.
    The returned frame is lazy: files appear when it is evaluated. Each file is written under
    a temporary name and moved, so a repeated or speculative task only replaces a file by an
    identical one. Names must differ, or one row would silently replace another, and stay inside the
    folder: repeated, missing and empty names and names with a slash are refused before anything is written. Works on any file system pyarrow can open; a path without
    scheme is on the cluster's default one.
    """
    folder = qualified(df.sparkSession, folder)
    rows = df.select(col(name).cast("string").alias("name"), col(text).alias("text"))
    outside = rows.filter(F.col("name").isNull() | F.col("name").isin("", ".", "..") | F.contains("name", F.lit("/"))).select("name").limit(3).collect()
    if outside:
        raise ValueError(f"not file names: {[r['name'] for r in outside]}")
    repeated = rows.groupBy("name").count().filter("count > 1").select("name").limit(3).collect()
    if repeated:
        raise ValueError(f"file names must differ, but these repeat: {[r['name'] for r in repeated]}")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _open_folder(folder)
        system.create_dir(root, recursive=True)
        made = {""}
        for batch in batches:
            out = []
            for key, body in zip(batch["name"], batch["text"]):
                sub = f"{zlib.crc32(key.encode()) % folders:04x}/" if folders else ""
                if sub not in made:
                    system.create_dir(f"{root}/{sub}", recursive=True)
                    made.add(sub)
                target = f"{root}/{sub}{key}{suffix}"
                part = f"{root}/{sub}.{uuid.uuid4().hex}.part"
                data = (body or "").encode("utf-8")
                with system.open_output_stream(part) as sink:
                    sink.write(data)
                system.move(part, target)
                out.append((f"{sub}{key}{suffix}", len(data)))
            yield pd.DataFrame(out, columns=["path", "size"])

    return rows.mapInPandas(write, "path string, size bigint")


def fetch_record(df: DataFrame, id_column: str, order: str, record: str | None = None, max_rows: int = 500) -> DataFrame:
    """The rows of one id, or the first ``max_rows`` in a stated order, then by id, when no id is given."""
    if record is not None:
        return df.filter(col(id_column) == record)
    return head(df, max_rows, order, id_column)
