"""Helpers shared by the operators: tables, learning split, checkpoints, text batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n`` (NULL for a NULL id)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it
    back: the lineage is cut and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm/{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of the batches that a step works on at once (one row at least).
SLICE_BYTES = 4 << 20


def map_batches(df: DataFrame, schema: T.StructType | str,
                start: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], limit: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` with per-task state: ``start()`` runs once per task and
    returns the function for each batch; larger batches are sliced by rows to
    about ``limit`` bytes, which bounds the work arrays of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            rows = max(1, -(-batch.num_rows // max(1, -(-batch.nbytes // limit))))
            for i in range(0, batch.num_rows, rows):
                yield step(batch.slice(i, rows))
    return df.mapInArrow(run, schema)


def add_columns(df: DataFrame, text: str, new: list[T.StructField],
                start: Callable[[], Callable[[pa.Array], list[pa.Array]]]) -> DataFrame:
    """All columns of ``df`` plus ``new`` ones computed from column ``text``.
    Input columns with the names of ``new`` are replaced."""
    names = {f.name.lower() for f in new}
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in names])
    schema = T.StructType([*kept.schema.fields, *new])
    at = kept.columns.index(text)

    def begin():
        fn = start()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*batch.columns, *fn(batch.column(at))],
                                              names=[*batch.schema.names, *[f.name for f in new]])
        return step
    return map_batches(kept, schema, begin)


#: Values of a group column up to which each is sampled by its own top-k.
FEW_VALUES = 1000


def sampled(rows: DataFrame, group: str, per_group: int) -> tuple[DataFrame, int]:
    """``sample_ids`` and a bound of its rows."""
    values = [r[0] for r in rows.select(group).distinct().orderBy(group).limit(FEW_VALUES + 2).collect()]
    values = [v for v in values if v is not None]
    if len(values) > FEW_VALUES:
        order = Window.partitionBy(group).orderBy(F.xxhash64("doc_id"), "doc_id")
        n = rows.select(group).distinct().count()
        return rows.filter(F.col(group).isNotNull()).withColumn("_n", F.row_number().over(order)) \
            .filter(F.col("_n") <= per_group).drop("_n"), n * per_group
    parts = [rows.filter(F.col(group) == F.lit(v)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_group) for v in values]
    if not parts:
        return rows.limit(0), 0
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, FEW_VALUES * per_group


def sample_ids(rows: DataFrame, group: str, per_group: int) -> DataFrame:
    """At most ``per_group`` rows (doc_id, group) per value of ``group``,
    those with the smallest id hash. No value is left out: up to
    ``FEW_VALUES`` each has a partial top-k, more are ranked in one window."""
    return sampled(rows, group, per_group)[0]
