"""Scans: CSV, JSON and Parquet with an explicit schema, time windows, nested documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwarden import fixed
from tabwarden.functions import cells


def _text_options(options: dict) -> dict:
    # enforceSchema off: a file whose header differs from the folder's is an error, not shifted cells.
    return {"header": True, "enforceSchema": False, "emptyValue": "", "mode": "PERMISSIVE", **options}


def _text_schema(names: Sequence[str], corrupt: str | None) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, *([corrupt] if corrupt else [])]])


def _cell(name: str, kind: T.DataType, options: dict) -> Column:
    text = cells.tokens_to_null(F.col(f"`{name}`"), fixed.CSV_NULL_TOKENS)
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return cells.to_number(text).cast(kind)
    plain = cells.strip_whitespace(text)
    if isinstance(kind, T.IntegralType):  # a whole number may be written as 3.0
        number = cells.to_number(text)
        return F.coalesce(plain.try_cast(kind), F.when(number == F.floor(number), number.try_cast(kind)))
    form = options.get("dateFormat" if isinstance(kind, T.DateType) else "timestampFormat")
    if form and isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.try_to_timestamp(plain, F.lit(form)).cast(kind)
    return plain.try_cast(kind)


def _typed(rows: DataFrame, schema: T.StructType, corrupt: str | None, options: dict) -> DataFrame:
    """The declared columns that the file has, by name and in their types."""
    found = [f for f in schema.fields if f.name in rows.columns]
    return rows.select(*[_cell(f.name, f.dataType, options).alias(f.name) for f in found], *([F.col(corrupt)] if corrupt else []))


def _declared(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str, first_file: bool = False, corrupt: str | None = None, **options
) -> DataFrame:
    """CSV by the names in its header; the declared columns come back in the declared order.

    A declared column that the header lacks is absent from the result, so that
    ``rules.require_columns`` can refuse the batch; further columns are left out. Missing tokens,
    empty cells and cells that are not of their type are NULL. ``first_file`` keeps the rows of the
    alphabetically first file of a folder. ``corrupt`` names a column that keeps the raw text of lines
    with too few or too many cells (NULL elsewhere). Each file of a folder goes by its own header: see
    ``read_files``.
    """
    declared, opts = _declared(schema), _text_options(options)
    if not first_file:
        found = spark.read.options(**opts).schema(_text_schema(declared.names, None)).csv(path).inputFiles()
        if len(found) > 1:
            return read_files(spark, path, declared, (), corrupt, **options)[0]
    if first_file:
        path = sorted(spark.read.options(**opts).schema(_text_schema(declared.names, None)).csv(path).inputFiles())[0]
    names = spark.read.options(**opts).csv(path).columns
    if not names:
        return spark.createDataFrame([], declared)
    if corrupt:
        opts["columnNameOfCorruptRecord"] = corrupt
    return _typed(spark.read.schema(_text_schema(names, corrupt)).options(**opts).csv(path), declared, corrupt, options)


def file_headers(spark: SparkSession, path: str | Sequence[str], **options) -> DataFrame:
    """``line``, ``files``: the distinct header lines of a folder and the files that begin with them; one pass over the text."""
    only = {k: v for k, v in options.items() if k in ("pathGlobFilter", "recursiveFileLookup")}
    lines = spark.read.options(**only).text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    # A file's first block is read in order by one task, so its least number is its first line.
    first = lines.withColumn("i", F.monotonically_increasing_id()).where("start = 0 AND trim(value) <> ''").groupBy("file").agg(F.min_by("value", "i").alias("line"))
    return first.groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files"))


def read_files(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, required: Sequence[str] = (), corrupt: str | None = None, **options
) -> tuple[DataFrame, DataFrame]:
    """The rows of CSV files, each by its own header, and the files that were refused (``file``, ``missing``).

    Files may order their columns differently. One that lacks a ``required`` column is refused alone;
    another declared column that it lacks is NULL in its rows. A declared column that no file has is
    absent from the result. Files of one header are one scan; the driver knows a name per file, as a
    listing does.
    """
    declared, opts = _declared(schema), _text_options(options)
    if corrupt:
        opts["columnNameOfCorruptRecord"] = corrupt
    plain = {k: v for k, v in opts.items() if k not in ("pathGlobFilter", "recursiveFileLookup")}  # files are named
    refused, frames = [], []
    for r in sorted(file_headers(spark, path, **options).collect(), key=lambda r: r["line"]):
        names = spark.read.options(**plain).csv(r["files"][0]).columns
        missing = sorted(set(required) - set(names))
        if missing:
            refused += [(f, missing) for f in r["files"]]
        elif names:
            rows = spark.read.schema(_text_schema(names, corrupt)).options(**plain).csv(r["files"])
            frames.append(_typed(rows, declared, corrupt, options))
    out = frames[0] if frames else spark.createDataFrame([], declared)
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    order = [n for n in declared.names if n in out.columns]
    turned = spark.createDataFrame(refused, "file string, missing array<string>")
    return out.select(*order, *([corrupt] if corrupt and corrupt in out.columns else [])), turned


def read_batch(spark: SparkSession, path: str, schema: T.StructType | str, **options) -> DataFrame:
    """A scoring batch; only ``.csv`` files are taken, and a batch without rows is refused."""
    df = read_csv(spark, path, schema, pathGlobFilter="*.csv", **options)
    return require_rows(df)


def stream_batches(
    spark: SparkSession, path: str, schema: T.StructType | str, max_files: int | None = None, corrupt: str | None = None, **options
) -> DataFrame:
    """A landing folder of CSV batches as a stream; ``max_files`` bounds a micro-batch.

    A stream knows its columns before its files: a header other than the declared one is an error.
    """
    declared, opts = _declared(schema), {**_text_options(options), "pathGlobFilter": "*.csv"}
    if max_files:
        opts["maxFilesPerTrigger"] = max_files
    if corrupt:
        opts["columnNameOfCorruptRecord"] = corrupt
    return _typed(spark.readStream.schema(_text_schema(declared.names, corrupt)).options(**opts).csv(path), declared, corrupt, options)


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("the source has no rows")
    return df


def read_documents(
    spark: SparkSession,
    fmt: str,
    path: str,
    schema: T.StructType | str | None = None,
    drop: tuple[str, ...] = ("_id",),
    nonempty: bool = False,
    **options,
) -> DataFrame:
    """A whole collection without its storage id; the format is any installed connector."""
    reader = spark.read.format(fmt).options(**options)
    rows = (reader.schema(schema) if schema else reader).load(path).drop(*drop)
    return require_rows(rows) if nonempty else rows


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_part(spark: SparkSession, path: str, part: str, column: str = "split") -> DataFrame:
    """One stored part of a split; a partition filter, so other parts are not opened."""
    return spark.read.parquet(path).where(F.col(column) == part).drop(column)


def trailing_window(df: DataFrame, at: str, asof: Column | str, days: int = fixed.WINDOW_DAYS) -> DataFrame:
    """Rows of the last ``days`` days before ``asof``; the bounds reach the scan as literals."""
    end = F.lit(asof).cast(df.schema[at].dataType) if isinstance(asof, str) else asof
    return df.where((F.col(at) >= end - F.expr(f"INTERVAL {days} DAYS")) & (F.col(at) < end))


def json_fields(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Replace a JSON text column by its fields; absent keys are NULL."""
    return df.withColumn("_json", F.from_json(column, schema)).select(*[c for c in df.columns if c != column], "_json.*")


def union_documents(*frames: DataFrame) -> DataFrame:
    """Documents of writers with different fields: union of columns, absent ones NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
