"""File listings, content hashes and url lists."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwarden.functions import paths, text
from clipwarden.spec import VIDEO_EXTENSIONS

#: Files from this size on are hashed in chunks.
STREAM_FROM = 1 << 30
CHUNK_BYTES = 8 << 20


def _empty_files(spark: SparkSession, folder: str) -> DataFrame:
    """Files without content, which file scans leave out: path, modificationTime, length.

    The driver lists the folder, as it does for any scan, and keeps the empty files only.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    pattern = hadoop.Path(folder)
    system = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    for place in system.globStatus(pattern) or []:
        for status in system.listStatus(place.getPath()):
            # scans take names that start like this for hidden files
            if status.isFile() and status.getLen() == 0 and not status.getPath().getName().startswith((".", "_")):
                rows.append((status.getPath().toString(), status.getModificationTime()))
    found = spark.createDataFrame(rows, "path string, at bigint")
    return found.select("path", F.timestamp_millis("at").alias("modificationTime"), F.lit(0).cast("bigint").alias("length"))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path, name and size of the files in a folder, empty ones included; contents are not read."""
    files = spark.read.format("binaryFile").load(folder).drop("content").unionByName(_empty_files(spark, folder))
    return files.select(
        F.regexp_replace("path", "^file:/+", "/").alias("path"),
        paths.basename(F.col("path")).alias("name"),
        F.col("length").alias("bytes"),
        (F.col("length") / F.lit(1048576.0)).alias("size_mb"),
        "modificationTime",
    )


def discover_clips(spark: SparkSession, folder: str, extensions: list[str] = VIDEO_EXTENSIONS) -> DataFrame:
    """Video files by extension, ignoring case, sorted by path."""
    wanted = [f".{e.strip().lower()}" for e in extensions]
    listed = list_files(spark, folder)
    return listed.filter(F.lower(paths.suffix(F.col("name"))).isin(wanted)).orderBy("path")


def content_hashes(
    spark: SparkSession, folder: str, stream_from: int = STREAM_FROM, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Path, name and sha256 per file, of files of any size.

    The file scan reads and hashes files below `stream_from` bytes; their content does not leave it. Larger
    files, which a column cannot hold from 2 GB on, are only listed by the scan and then read in chunks of
    `chunk_bytes` through `pyarrow.fs`, so a task holds one chunk. The scan deals files to tasks by their
    size. Both sizes are filters of the scan: no content is read twice.
    """
    files = spark.read.format("binaryFile").load(folder)
    small = files.filter(F.col("length") < stream_from).select("path", F.sha2("content", 256).alias("sha256"))

    def streamed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"path": [uri], "sha256": [stream_sha256(uri, chunk_bytes)]})

    large = files.filter(F.col("length") >= stream_from).select("path")
    empty = _empty_files(spark, folder).select("path", F.sha2(F.lit(b""), 256).alias("sha256"))
    hashed = small.unionByName(empty).unionByName(large.mapInArrow(streamed, "path string, sha256 string"))
    path = F.regexp_replace("path", "^file:/+", "/")
    return hashed.select(path.alias("path"), paths.basename(path).alias("name"), "sha256")


def stream_sha256(uri: str, chunk_bytes: int) -> str:
    """Hash of a file that is read chunk by chunk; `uri` is a path or a uri with a scheme."""
    # Spark shows local files as file:/a or file:///a
    local = re.sub("^file:/+", "/", uri)
    system, place = (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(quote(uri, safe=":/@"))
    digest = hashlib.sha256()
    with system.open_input_stream(place, buffer_size=0) as stream:
        while chunk := stream.read(chunk_bytes):
            digest.update(chunk)
    return digest.hexdigest()


def read_urls(spark: SparkSession, path: str) -> DataFrame:
    """Urls of a list file; blank lines and `#` comments are left out."""
    return (
        spark.read.text(path)
        .select(text.strip(F.col("value")).alias("url"))
        .filter((F.col("url") != "") & ~F.col("url").startswith("#"))
    )
