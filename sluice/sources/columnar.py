"""A3 + B11 + F2: read the Arrow IPC files named by BATCH manifests.

A file is cut into runs of record batches, which its footer locates, so one
large file is read by several tasks. Decimal columns travel as text and are cast
to the declared type, so no precision is lost (Spark's Arrow reader also refuses
32/64-bit decimals). Files whose schemas differ are read as separate groups; a
load casts every group to its plan before it concatenates them.
Each row carries (_file_ord, _row_ord): manifest position, then the row's place
in the file: the record batch's number in the upper 32 bits, its row below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.merge import union_promote

FILE_ORD, ROW_ORD = "_file_ord", "_row_ord"
SPLIT_BYTES = 64 << 20  # of a file, for one task
MAX_TASKS = 10_000  # of one scan; more splits share tasks
_SPLITS = "ordinal long, path string, first long, past long, schema binary"


def strip_file_uri(paths: list[str]) -> list[str]:
    return [p[len("file://"):] if p.startswith("file://") else p for p in paths]


def _open(path: str):
    import pyarrow.ipc as ipc

    if "://" in path:
        fs, inner = _filesystem(path)
        return ipc.open_file(fs.open_input_file(inner))
    return ipc.open_file(path)


def _text_decimals(batch):
    import pyarrow as pa

    cols, fields = [], []
    for field, col in zip(batch.schema, batch.columns):
        if pa.types.is_decimal(field.type):
            col = col.cast(pa.string())
            field = pa.field(field.name, pa.string())
        cols.append(col)
        fields.append(field)
    return pa.RecordBatch.from_arrays(cols, schema=pa.schema(fields))


def _splits(split_bytes: int):
    def describe(it):
        import pandas as pd
        import pyarrow as pa

        for pdf in it:
            out = []
            for ordinal, path in zip(pdf["ordinal"], pdf["path"]):
                fs, inner = _filesystem(path)
                size = fs.get_file_info(inner).size
                with _open(path) as reader:
                    schema = _text_decimals(pa.RecordBatch.from_pylist([], schema=reader.schema)).schema.serialize().to_pybytes()
                    batches = reader.num_record_batches
                step = max(1, batches * split_bytes // max(size, 1))
                for first in range(0, max(batches, 1), step):  # a file without a batch still has a schema
                    out.append((int(ordinal), path, first, min(first + step, batches), schema))
            yield pd.DataFrame(out, columns=["ordinal", "path", "first", "past", "schema"])

    return describe


def _reader(it):
    import numpy as np
    import pyarrow as pa

    for split in it:
        for ordinal, path, first, past in zip(*(split.column(c).to_pylist() for c in ("ordinal", "path", "first", "past"))):
            with _open(path) as reader:
                for i in range(first, past):
                    rb = _text_decimals(reader.get_batch(i))
                    n = rb.num_rows
                    rb = rb.append_column(FILE_ORD, pa.array(np.full(n, ordinal, np.int64)))
                    rb = rb.append_column(ROW_ORD, pa.array((i << 32) + np.arange(n, dtype=np.int64)))
                    yield rb


def scan_columnar_groups(spark: SparkSession, paths: list[str], first_ordinal: int = 0,
                         split_bytes: int = SPLIT_BYTES) -> list[DataFrame]:
    """A3: one DataFrame per distinct file schema, in the order of their first files.
    The driver gets one row per schema; files and their splits stay a DataFrame."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import from_arrow_schema

    paths = strip_file_uri(paths)
    if not paths:
        raise ValueError("empty manifest")
    listing = spark.createDataFrame([(first_ordinal + i, p) for i, p in enumerate(paths)], "ordinal long, path string")
    splits = listing.repartitionByRange(min(len(paths), MAX_TASKS), "ordinal").mapInPandas(_splits(split_bytes), _SPLITS)
    groups = splits.groupBy("schema").agg(F.min("ordinal").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    frames = []
    for group in sorted(groups, key=lambda g: g["first"]):
        blob = bytes(group["schema"])
        arrow_schema = pa.ipc.read_schema(pa.py_buffer(blob))
        arrow_schema = arrow_schema.append(pa.field(FILE_ORD, pa.int64())).append(pa.field(ROW_ORD, pa.int64()))
        members = splits.filter(F.col("schema") == F.lit(blob)).drop("schema")
        members = members.repartitionByRange(min(group["n"], MAX_TASKS), "ordinal", "first")
        frames.append(members.mapInArrow(_reader, from_arrow_schema(arrow_schema)))
    return frames


def scan_columnar_batches(spark: SparkSession, paths: list[str], first_ordinal: int = 0) -> DataFrame:
    """A3: all rows of all files, promoted to one schema. Decimals next to other
    numbers widen to double here; a load casts each group to its plan first."""
    return union_promote(scan_columnar_groups(spark, paths, first_ordinal))


def _filesystem(path: str):
    """(pyarrow filesystem, path inside it); plain paths are local."""
    import pyarrow.fs as pafs

    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def remove_sources(paths: list[str]) -> list[str]:
    """Delete loaded files after the commit; a failed delete only warns."""
    import warnings

    failed = []
    for p in strip_file_uri(paths):
        try:
            fs, inner = _filesystem(p)
            fs.delete_file(inner)
        except (OSError, FileNotFoundError):
            failed.append(p)
    if failed:
        warnings.warn(f"could not remove {len(failed)} loaded batch file(s), e.g. {failed[0]}")
    return failed


def _writer(directory: str):
    def write(it):
        import uuid

        import pyarrow as pa
        import pyarrow.ipc as ipc

        path = f"{directory}/part-{uuid.uuid4().hex}.arrow"
        fs, inner = _filesystem(path)
        sink = writer = None
        rows = 0
        for batch in it:  # one batch in memory at a time
            if writer is None:
                sink = fs.open_output_stream(inner)
                writer = ipc.new_file(sink, batch.schema)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "rows": [rows]})

    return write


def write_arrow_files(df: DataFrame, directory: str) -> list[str]:
    """Write each partition of `df` as one Arrow IPC file (a tap's BATCH
    output); returns the manifest, sorted."""
    fs, inner = _filesystem(directory)
    fs.create_dir(inner, recursive=True)
    out = df.mapInArrow(_writer(directory), "path string, rows long").collect()
    return sorted(r["path"] for r in out)
