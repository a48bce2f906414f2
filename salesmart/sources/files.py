"""

* ``discover`` lists data files under a root recursively, keeping names that
  end in ``.csv`` in any letter case; the listing is a Spark scan of
  ``binaryFile`` metadata (``content`` is pruned, only paths are read).
* ``read_headers`` gets the header of every file. Default: the discovered
  file list (metadata only) is spread over tasks and each task reads just
  the first line of its files with Arrow's file systems, so the probe costs
  O(files), not O(bytes). Hadoop's ``s3a://``/``s3n://`` paths are opened as
  ``s3://`` (``arrow_uri``). Files whose URI scheme Arrow cannot open fall
  back to a Spark text scan of those files only:
  the first line of each file's first split, chosen by ``min_by`` over a
  partition-ordered id (a filter on ``_metadata.file_block_start`` does not
  prune splits, so this path reads the files whole).
* ``read_sales_csv`` scans files with an explicit schema (no inference pass),
  binding columns by the header order of that file group.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.schemas import SALES, csv_schema
from salesmart.sources.paths import comparable, for_reader, plain, uri

# The accepted file suffix, matched case-insensitively.
CSV_GLOB = "*.[cC][sS][vV]"


def _file_reader(spark: SparkSession, fmt: str, glob: str = CSV_GLOB):
    return (spark.read.format(fmt)
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob))


def discover(spark: SparkSession, root: str, glob: str = CSV_GLOB, require: bool = True) -> DataFrame:
    """``path, length, modificationTime`` of every matching file under ``root``.

    Raises ``FileNotFoundError("No Data available to process")`` when nothing
    matches and ``require`` is set.
    """
    files = _file_reader(spark, "binaryFile", glob).load(root).select("path", "length", "modificationTime")
    if require and files.isEmpty():
        raise FileNotFoundError(f"No Data available to process under {root}")
    return files


def read_discovered_lines(spark: SparkSession, root: str, glob: str = CSV_GLOB) -> DataFrame:
    """Text lines of exactly the files ``discover`` lists (same recursive
    lookup and suffix filter), read in one scan without a driver-side path list."""
    return _file_reader(spark, "text", glob).load(root)


# A quoted field (a backslash escapes the next character), and any
# field of a line: quoted up to a quote before a comma or the end, or up to the next comma.
_QUOTED = r'^"(?:[^"\\]|\\.)*"$'
_FIELD = r'(?:^|,)("(?:[^"\\]|\\.|"(?!,|$))*"(?=,|$)|[^,]*)'


def header_columns(line) -> "F.Column":
    """The column names of a header line, as Spark's CSV reader names them.

    Commas inside quotes belong to the name; quotes stay where one is not
    escaped inside. An empty name becomes ``_c<i>``,
    and names that are equal but for case each get their position appended, so
    a header with ``price`` twice has no column ``price``."""
    quoted = F.transform(F.regexp_extract_all(line, F.lit(_FIELD), F.lit(1)), lambda c: F.when(
        c.rlike(_QUOTED), F.regexp_replace(F.substring(c, F.lit(2), F.length(c) - 2), r"\\(.)", "$1")).otherwise(c))
    return unique_names(F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ",")))


def unique_names(fields) -> "F.Column":
    """``fields``, told apart by position where they are empty or repeated."""
    lowered = F.array_sort(F.transform(fields, F.lower))
    repeated = F.array_distinct(F.filter(lowered, lambda c, i: (i > 0) & (c == F.get(lowered, F.greatest(i - 1, F.lit(0))))))
    apart = F.transform(fields, lambda c, i: F.when(c == "", F.concat(F.lit("_c"), i.cast("string")))
                        .when(F.array_contains(repeated, F.lower(c)), F.concat(c, i.cast("string"))).otherwise(c))
    clear = (F.size(F.array_distinct(lowered)) == F.size(fields)) & ~F.array_contains(fields, "")
    return F.when(clear, fields).otherwise(apart)


#: Column with the path of a row's file, where asked for.
SOURCE = "source_file"

# Names that can be columns of a frame as they are.
_REGULAR = re.compile(r"[A-Za-z][A-Za-z0-9_ -]*")


def reader_names(header: list[str]) -> list[str]:
    """The names under which a file's columns are read: its own, or ``_f<i>``
    by position where one may have been told apart (so the file's own header
    differs) or would clash with another column."""
    own = all(_REGULAR.fullmatch(c) and not c.endswith(str(i)) and c.lower() != SOURCE for i, c in enumerate(header)) \
        and len({c.lower() for c in header}) == len(header)
    return list(header) if own else [f"_f{i}" for i in range(len(header))]


# Hadoop URI schemes and the Arrow scheme that opens the same objects.
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def arrow_uri(path: str) -> str:
    """The URI Arrow's file systems understand for a Hadoop path (``s3a://b/k``
    → ``s3://b/k``); other paths are returned unchanged."""
    scheme, sep, rest = path.partition("://")
    alias = ARROW_SCHEMES.get(scheme.lower()) if sep else None
    return f"{alias}://{rest}" if alias else path


def _first_lines(batches):
    """mapInPandas helper: first line of each file path (NULL if unreadable);
    a file is read up to its first newline or its end."""
    import pandas as pd
    import pyarrow.fs as pafs

    for pdf in batches:
        out = []
        for path in pdf["file_path"]:
            try:
                if path.startswith("/") or path[:5].lower() == "file:":
                    fs, inner = pafs.LocalFileSystem(), comparable(path)
                else:
                    fs, inner = pafs.FileSystem.from_uri(uri(arrow_uri(path)))
                parts = []
                with fs.open_input_stream(inner) as f:
                    while chunk := f.read(65536):
                        parts.append(chunk)
                        if b"\n" in chunk:
                            break
                line = b"".join(parts).split(b"\n", 1)[0].rstrip(b"\r").decode("utf-8", errors="replace")
                out.append(line.lstrip("\ufeff"))
            except Exception:  # noqa: BLE001 - scheme unknown to Arrow: Spark scan fallback
                out.append(None)
        yield pd.DataFrame({"file_path": pdf["file_path"], "value": out})


def read_headers(spark: SparkSession, root: str | list[str], glob: str = CSV_GLOB,
                 method: str = "auto") -> DataFrame:
    """``file_path, header`` (array<string>) for every matching file.

    ``method="auto"`` probes first lines per file (Arrow, in tasks) and scans
    with Spark only the files Arrow cannot open; ``"scan"`` always scans.
    """
    if method == "scan":
        return _scan_headers(spark, root, glob)
    files = _file_reader(spark, "binaryFile", glob).load(root).select(F.col("path").alias("file_path"))
    return headers_of(spark, files, glob)


def headers_of(spark: SparkSession, files: DataFrame, glob: str = CSV_GLOB) -> DataFrame:
    """S4 for a frame of ``file_path`` values (e.g. the new files of a stream
    micro-batch): ``file_path, header``, probing first lines in tasks.

    Nothing is cached here (a cache nobody unpersists would pin memory for
    every micro-batch of a long-running stream): finding the unreadable files
    is one O(files) pass, and callers that use the result more than once
    cache it for the run and unpersist it."""
    probed = files.select("file_path").mapInPandas(_first_lines, "file_path string, value string")
    missing = [r.file_path for r in probed.where(F.col("value").isNull()).select("file_path").collect()]
    got = probed.where(F.col("value").isNotNull()).select("file_path", header_columns("value").alias("header"))
    if not missing:
        return got
    return got.unionByName(_scan_headers(spark, missing, glob))


def _scan_headers(spark: SparkSession, root: str | list[str], glob: str = CSV_GLOB) -> DataFrame:
    """Header probe by a Spark text scan (reads the files whole). A list of
    roots holds plain paths, a single root is a reader's path."""
    reader = _file_reader(spark, "text", glob)
    lines = reader.load([for_reader(p) for p in root] if isinstance(root, list) else root)
    first_split = lines.where(F.col("_metadata.file_block_start") == 0).select(
        plain(F.col("_metadata.file_path")).alias("file_path"),
        F.monotonically_increasing_id().alias("pos"),
        "value",
    )
    return first_split.groupBy("file_path").agg(
        header_columns(F.min_by("value", "pos")).alias("header"))


def read_sales_csv(spark: SparkSession, paths: list[str] | str, header: list[str] | None = None,
                   with_source: bool = False, bad: str | None = None) -> DataFrame:
    """Typed scan of sales CSV files that share one header.

    Columns bind by position to ``header`` (default: the canonical order) and
    are named by ``reader_names``. Where these are the header's own names,
    ``enforceSchema=false`` makes Spark check each file's header against them.
    Unparsable values become NULL (PERMISSIVE); with ``bad`` a column of that
    name holds the raw line of such rows (NULL for the others).
    """
    names = header or [f.name for f in SALES.fields if f.name != "additional_column"]
    schema = csv_schema(names)
    read_as = reader_names(names)
    schema = T.StructType([T.StructField(c, f.dataType) for c, f in zip(read_as, schema.fields)])
    if bad:
        schema = schema.add(bad, "string")
    df = (spark.read.schema(schema)
          .option("columnNameOfCorruptRecord", bad or "_corrupt_record")
          .option("columnPruning", "false" if bad else "true")
          .option("header", "true")
          .option("enforceSchema", str(read_as != names).lower())
          .option("mode", "PERMISSIVE")
          .csv(paths))
    if with_source:
        df = df.withColumn(SOURCE, plain(F.col("_metadata.file_path")))
    return df


def empty_sales(spark: SparkSession) -> DataFrame:
    """An empty relation of the canonical sales schema (union seed)."""
    return spark.createDataFrame([], SALES)
