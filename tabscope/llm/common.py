"""What the text operators share: reading tables, the shared folder, and texts as Arrow columns."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.errors import AnalysisError

#: Name of the row number that operators add for their own use.
ROW = "__row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors see.

    Where it is unset, a temporary folder serves a session in a single process; a cluster has none that its machines share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._conf.get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise AnalysisError("no_shared_folder", "spark.checkpoint.dir has to name a folder that all executors share.")
        root = "file://" + tempfile.mkdtemp(prefix="tabscope-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/tabscope-{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """The frame, written to the shared folder and read again: computed once, and safe from lost executors."""
    path = shared_folder(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Removes the folder of a frame of ``stored`` that nothing reads any more."""
    spark = frame.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
        if re.fullmatch(r"tabscope-[0-9a-f]{32}", path.rsplit("/", 1)[-1]):
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Row number, id and text as UTF-8 bytes (null: empty), whatever else the table holds.

    The row number keeps rows with equal or null ids apart. It depends on the scan alone, so a repeated task gives the same.
    """
    return docs.select(
        F.monotonically_increasing_id().alias(ROW),
        F.col(id_col).alias(id_col),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("__text"),
    )


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each holds about ``most`` bytes of a binary column (null: none), or one row."""
    for b in batches:
        if not b.num_rows:
            continue
        ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(b.column(column)), 0).cast(pa.int64())).to_numpy()
        start = 0
        while start < b.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(ends.searchsorted(base + most, side="right")))
            yield b.slice(start, stop - start)
            start = stop
