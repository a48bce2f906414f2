"""File paths as plain text, and their forms for readers.

Listings (``binaryFile``) give plain paths, ``_metadata.file_path`` gives
URI-encoded ones, and readers take glob patterns. The engine passes plain
paths around; these helpers convert at the edges.
"""

from __future__ import annotations

import re
from urllib.parse import quote

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_GLOB = re.compile(r"([\\{}\[\]*?])")
_FILE = re.compile(r"^file:/*(?=/)", re.IGNORECASE)


def plain(encoded: Column) -> Column:
    """The plain path of a URI-encoded path column ("%20" is a space, "+" stays)."""
    return F.url_decode(F.regexp_replace(encoded, r"\+", "%2B"))


def for_reader(path: str) -> str:
    """A plain path as a reader's glob pattern that matches just this path."""
    return _GLOB.sub(r"\\\1", path)


def comparable(path: str) -> str:
    """``file:///x``, ``file:/x`` and ``/x`` alike, without a final slash."""
    return _FILE.sub("", path.rstrip("/")) or "/"


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under ``path`` (none if it does not exist):
    one listing of one folder, through the file system Spark uses."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop) if s.isDirectory())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def make_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop)


def signature(spark: SparkSession, path: str) -> tuple:
    """Length and modification time of a file, or of a folder's files."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(hadoop))


def delete_folder(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def uri(path: str) -> str:
    """A plain path with a scheme as a quoted URI."""
    scheme, sep, rest = path.partition("://")
    return f"{scheme}://{quote(rest)}" if sep else quote(path)
