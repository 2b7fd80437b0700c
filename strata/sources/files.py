"""Data files named by a table of paths, read in tasks.

The paths stay a DataFrame: they are dealt to tasks, which open the files (or get
their bytes from the ``contents`` table) and give rows of the caller's schema, batch
by batch.  Nothing about a single file passes through the driver.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FORMATS = ("parquet", "csv", "json", "text")


def _files_of(address: str) -> Iterator[io.IOBase]:
    """The file at an address, or those of the folder there, opened."""
    from pyarrow import fs
    if address.startswith("file:"):
        address = "/" + address.removeprefix("file:").lstrip("/")
    store, path = fs.FileSystem.from_uri(address)
    if store.get_file_info(path).type != fs.FileType.Directory:
        yield store.open_input_file(path)
        return
    for info in store.get_file_info(fs.FileSelector(path, recursive=True)):
        hidden = any(part[0] in "_." for part in info.path[len(path):].strip("/").split("/") if part)
        if info.type == fs.FileType.File and not hidden:
            yield store.open_input_file(info.path)


def _lines(source: io.IOBase) -> Iterator[pa.RecordBatch]:
    left = b""
    while True:
        part = source.read(1 << 20)
        *whole, left = (left + part).split(b"\n") if part else [left] * bool(left) + [b""]
        if whole:
            yield pa.RecordBatch.from_arrays([pa.array([w.removesuffix(b"\r") for w in whole], pa.binary()).cast(pa.string())], ["value"])
        if not part:
            return


def _batches(source: io.IOBase, fmt: str, names: list[str], options: dict[str, str]) -> Iterator[pa.RecordBatch]:
    if fmt == "text":
        yield from _lines(source)
    elif fmt == "parquet":
        import pyarrow.parquet as pq
        f = pq.ParquetFile(source)
        yield from f.iter_batches(columns=[n for n in f.schema_arrow.names if n in names])
    elif fmt == "csv":
        from pyarrow import csv
        header = options.get("header", "false").lower() == "true"
        text = csv.ConvertOptions(column_types={n: pa.string() for n in names}, strings_can_be_null=True)
        try:
            yield from csv.open_csv(source, csv.ReadOptions(column_names=None if header else names),
                                    csv.ParseOptions(delimiter=options.get("sep", ",")), text)
        except pa.ArrowInvalid as e:
            if "Empty CSV" not in str(e):
                raise
    else:
        from pyarrow import json
        data = source.read()
        if data.strip():
            yield from json.read_json(io.BytesIO(data)).to_batches()


def _as(batch: pa.RecordBatch, schema: pa.Schema) -> list[pa.Array]:
    """The batch's columns as those of ``schema``; missing ones are null."""
    out = []
    for field in schema:
        at = batch.schema.get_field_index(field.name)
        out.append(pa.nulls(len(batch), field.type) if at < 0 else batch.column(at).cast(field.type))
    return out


def read_paths(paths: DataFrame, schema: StructType, fmt: str = "parquet", address: str = "address",
               contents: DataFrame | None = None, keep: tuple[str, ...] = (), num_partitions: int | None = None,
               to_path: Callable[[str], str] | None = None, **options: str) -> DataFrame:
    """The rows of the files at ``paths[address]``: columns ``keep`` of their row of
    ``paths``, then those of ``schema`` (a column that a file lacks is null).

    With ``contents`` (checksum, content) the bytes come from this table, joined on
    the address; else tasks open the address, mapped by ``to_path``, with pyarrow's
    file systems.  ``fmt``: parquet, csv (options header, sep), json, text (column
    ``value``).  A file is read by one task; a row of ``paths`` that repeats is
    read again."""
    from pyspark.sql.pandas.types import to_arrow_schema
    if fmt not in FORMATS:
        raise ValueError(f"fmt: one of {', '.join(FORMATS)}")
    spark = paths.sparkSession
    rows = paths.select(*keep, F.col(address).alias("_address"))
    if contents is not None:
        bytes_of = contents.select(F.col("checksum").alias("_address"), F.col("content").alias("_content"))
        rows = rows.join(bytes_of, "_address")
    else:
        rows = rows.repartition(num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), "_address")
    arrow = to_arrow_schema(schema)
    kept = [rows.schema[c] for c in keep]
    stored = contents is not None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                where = batch["_address"][i].as_py()
                if where is None:
                    continue
                sources = [pa.BufferReader(batch["_content"][i].as_buffer())] if stored else _files_of(to_path(where) if to_path else where)
                for source in sources:
                    for part in _batches(source, fmt, arrow.names, options):
                        own = [pa.repeat(batch[c][i], len(part)) for c in keep]
                        yield pa.RecordBatch.from_arrays([*own, *_as(part, arrow)], [*keep, *arrow.names])

    return rows.mapInArrow(run, StructType([*kept, *schema.fields]))
