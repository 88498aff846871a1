"""Counts and value ranges from Parquet footers: no row group is read."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

_FILES_A_TASK = 64


def footer_profile(spark: SparkSession, path: str, value: str, kind: DataType) -> DataFrame:
    """(file_path, rows, nulls, min_value, max_value, known) of every Parquet file below ``path``, for a top-level column
    of type ``kind``.

    Spark lists the files without opening them; tasks read the footers of some files each. Where ``known`` is false
    the file has no statistics of the column, as for timestamps in the old 96-bit format: scan it with ``file_profile``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.parquet").load(path).select("path")  # without their content
    tasks = max(1, -(-files.count() // _FILES_A_TASK))
    schema = pa.schema([("file_path", pa.string()), ("rows", pa.int64()), ("nulls", pa.int64()),
                        ("min_value", pa.string()), ("max_value", pa.string()), ("known", pa.bool_())])

    # Inside, so that tasks need not import this package.
    def profile(path: str) -> tuple:
        place, name = fs.FileSystem.from_uri(path)
        with place.open_input_file(name) as file:
            footer = pq.read_metadata(file)
        names = [footer.schema.column(i).path for i in range(footer.num_columns)]
        if value not in names:  # files written before the column existed
            return path, footer.num_rows, footer.num_rows, None, None, True
        at, nulls, low, high, known = names.index(value), 0, None, None, True
        for g in range(footer.num_row_groups):
            column = footer.row_group(g).column(at)
            found = column.statistics
            if found is None or not found.has_null_count:
                known = False
                continue
            nulls += found.null_count
            if column.physical_type != "INT96" and found.has_min_max:
                low = found.min if low is None else min(low, found.min)
                high = found.max if high is None else max(high, found.max)
            elif column.num_values > found.null_count:
                known = False
        ends = (None if v is None else str(v) for v in (low, high))
        return path, footer.num_rows, nulls, *ends, known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [profile(file) for file in batch.column("path").to_pylist()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    found = files.repartition(tasks, "path").mapInArrow(
        run, "file_path string, rows bigint, nulls bigint, min_value string, max_value string, known boolean")
    return found.select("file_path", "rows", "nulls", *[F.col(c).cast(kind).alias(c) for c in ("min_value", "max_value")], "known")
