"""Which files a dataset consists of, and whether they were replaced."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BLOCK = 8 * 1024 * 1024


def file_manifest(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, name, size, sha256`` of every file under a path.

    The listing reads no content; the files are then hashed in parallel, one
    task per file, in blocks and to the end.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"))
    )

    # Nested, so that it travels with the task and the executors need no package.
    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sums = []
            for uri in batch["path"]:
                scheme, rest = uri.split(":", 1)
                files, name = fs.FileSystem.from_uri(f"{scheme}://{rest}" if not rest.startswith("//") else uri)
                digest = hashlib.sha256()
                with files.open_input_stream(name, compression=None) as stream:
                    while block := stream.read(block_size):
                        digest.update(block)
                sums.append(digest.hexdigest())
            yield batch.assign(sha256=sums)

    block_size = _BLOCK
    return listing.mapInPandas(digests, "path string, name string, size bigint, sha256 string")


def changed_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """Files added, removed or replaced between two manifests: ``path, change``."""
    old, new = before.alias("old"), after.alias("new")
    same = (F.col("old.size") == F.col("new.size")) & (F.col("old.sha256") == F.col("new.sha256"))
    return (
        old.join(new, F.col("old.path") == F.col("new.path"), "full_outer")
        .select(
            F.coalesce("new.path", "old.path").alias("path"),
            F.when(F.col("old.path").isNull(), "added")
            .when(F.col("new.path").isNull(), "removed")
            .when(~same, "replaced")
            .alias("change"),
        )
        .where(F.col("change").isNotNull())
    )
