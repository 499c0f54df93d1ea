"""Helpers of the text operators: shared storage and Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: White space between words, as code points 9 to 13 and 32.
SPACES = "\t\n\x0b\x0c\r "
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Texts handed to Python at a time; the Arrow batch they are cut from may be larger.
SLICE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local session without one gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"file://{os.path.join(tempfile.gettempdir(), 'checkpoints')}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: later steps restart from the files."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_texts(
    df: DataFrame,
    start: Callable[[], Callable[..., Sequence[tuple]]],
    fields: Sequence[T.StructField],
    reads: Sequence[str] = ("text",),
) -> DataFrame:
    """Adds columns that a Python function computes from ``reads``, slice by slice.

    ``start`` runs once per task and returns a function from lists of values (one list per column
    read) to one tuple of new values per row. All other columns pass through as Arrow arrays, so
    NULLs and large integers keep their type. A new column replaces one of the same name.
    """
    kept = df.drop(*[f.name for f in fields if f.name not in reads])
    positions = [kept.columns.index(c) for c in reads]
    replaced = [f.name for f in fields if f.name in reads]
    passed = [c for c in kept.columns if c not in replaced]
    schema = T.StructType([*[kept.schema[c] for c in passed], *fields])
    names = schema.names
    keep = [kept.columns.index(c) for c in passed]
    types = [to_arrow_type(f.dataType) for f in fields]

    def run(batches):
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                made = work(*[part.column(i).to_pylist() for i in positions])
                new = [pa.array([row[k] for row in made], kind) for k, kind in enumerate(types)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in keep], *new], names=names
                )

    return kept.mapInArrow(run, schema)


def unused(columns: Sequence[str]) -> str:
    """A prefix that no column's name begins with."""
    mark = "_"
    while any(c.lower().startswith(mark) for c in columns):
        mark += "_"
    return mark


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once per row however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text falls into the part kept from learning. NULL ids do not."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))
