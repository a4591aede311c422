"""What the operators of this package share: Arrow passes, checkpoints, row ids, held-out rows."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text handled at a time inside a task; keeps Python's lists small whatever Arrow delivers.
SLICE_BYTES = 4 << 20
#: Rows of a batch on the way to Python and back; both sides hold whole batches in memory.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_BATCH_ROWS = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(maxsize=8)
def _package_archive(application: str) -> str:
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "loanrisk")
    return shutil.make_archive(archive, "zip", root, "loanrisk")


def with_package(spark: SparkSession) -> None:
    """Let Spark hand this library to the Python workers, once per application, wherever they run,
    and keep the session's batches small: documents are large rows."""
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= MOST_BATCH_ROWS:
        spark.conf.set(BATCH_ROWS, str(MOST_BATCH_ROWS))
    context = spark.sparkContext
    archive = _package_archive(context.applicationId)
    if not any(file.endswith(os.path.basename(archive)) for file in context.listFiles):
        context.addPyFile(archive)


def arrow_pass(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[list[pa.Array]]], schema: T.StructType
) -> DataFrame:
    """mapInArrow with this library at hand; ``function`` yields the columns of batches.

    Columns are called by place on the way, so names may clash as they please.
    """
    with_package(df.sparkSession)
    places = [f"column_{place}" for place in range(len(schema))]
    placed = T.StructType([
        T.StructField(place, field.dataType, field.nullable) for place, field in zip(places, schema)
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for arrays in function(batches):
            yield pa.RecordBatch.from_arrays(arrays, places)

    renamed = df.toDF(*(f"column_{place}" for place in range(len(df.columns))))
    return renamed.mapInArrow(run, placed).toDF(*schema.names)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share: spark.checkpoint.dir. On one machine, if it is unset, one of
    our own; on several there is none to guess, which is an error."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        configured = context.getConf().get("spark.checkpoint.dir")
        if not configured and not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with files in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of df is called so."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with its columns called by their place, and the place of each name in lower case."""
    places = [f"column_{place}" for place in range(len(df.columns))]
    return df.toDF(*places), {name.lower(): place for name, place in zip(df.columns, places)}


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet in the shared folder and read back: cut off like a checkpoint, compressed,
    and of later reads only the columns they ask for."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stored-{uuid.uuid4()}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Add an id per row that is the same at every read: the file (its hash) and the place in it.

    How Spark cuts files into partitions follows the cores that are alive; the id does not. Rows that
    are no plain scan of files are written to the shared folder first.
    """
    try:
        place = df.metadataColumn("_metadata")
        return df.withColumn(name, F.struct(
            F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("place")
        ))
    except AnalysisException:
        rows, places = positional(df)
        plain = stored(rows)
        return numbered(plain, unused(plain, name)).toDF(*df.columns, name)


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def slices(batch: pa.RecordBatch, text_column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batch in runs of rows of about SLICE_BYTES of text, at least one row each."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text_column)), 0).to_pylist()
    start = held = 0
    for row, length in enumerate([*lengths, SLICE_BYTES + 1]):
        if row > start and held + length > SLICE_BYTES:
            part = batch.slice(start, row - start)
            yield part, text_bytes(part.column(text_column))
            start, held = row, 0
        held += length + 1


def map_texts(
    df: DataFrame,
    keep: Sequence[str | Column],
    text: Column,
    function: Callable[[pa.RecordBatch, list[bytes]], list[pa.Array]],
    fields: Sequence[T.StructField],
) -> DataFrame:
    """The kept columns and new ones that ``function`` derives from slices of rows.

    ``function`` gets a slice of the kept columns and the texts' bytes, and returns one array per
    field, as long as the slice.
    """
    kept = df.select(*keep)
    source = df.select(*keep, text.cast("string"))
    schema = T.StructType([*kept.schema.fields, *fields])
    last = len(kept.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            for part, texts in slices(batch, last):
                yield [*part.columns[:last], *function(part, texts)]

    return arrow_pass(source, run, schema)
