"""CSV and Parquet layers in Hive-style folders, and their catalog tables."""

from __future__ import annotations

import csv
import logging
import re
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.clean import add_layer_columns
from candlewick.schemas import LAYER_PARTITIONS

log = logging.getLogger(__name__)

CSV_FILES = "*.[cC][sS][vV]"
GLOB = re.compile(r"([\\\[\]{}*?])")
# Spark's own default keeps milliseconds only.
CSV_WRITE = {"header": "true", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _headers(spark: SparkSession, path: str, any_folders: bool, options: dict) -> list[tuple[str, list[str]]]:
    """The different header lines below ``path``, each with its files. Files without a line are left out.

    The lines come from one scan of the files as text; the list of files is the only thing collected.
    """
    reader = spark.read.option("pathGlobFilter", CSV_FILES).option("recursiveFileLookup", any_folders)
    kept = {name: value for name, value in options.items() if name.lower() in ("encoding", "linesep")}
    lines = reader.options(**kept).text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            files = batch.column(1).dictionary_encode()
            places = files.indices.to_numpy(zero_copy_only=False)
            for at in np.flatnonzero(np.r_[True, places[1:] != places[:-1]]) if batch.num_rows else ():
                file = batch.column(1)[int(at)].as_py()
                if file != last and batch.column(2)[int(at)].as_py() == 0:
                    yield pa.RecordBatch.from_arrays([pa.array([batch.column(0)[int(at)].as_py()]), pa.array([file])], names=["line", "file"])
                last = file

    found: dict[str, list[str]] = {}
    for row in lines.mapInArrow(first_lines, "line string, file string").distinct().collect():
        found.setdefault(row["line"].strip("\r\ufeff"), []).append(row["file"])
    # File paths come as URIs; a reader takes plain paths, in which some characters stand for many files.
    return [(line, sorted(GLOB.sub(r"\\\1", unquote(file)) for file in files)) for line, files in sorted(found.items())]


def _one_type(kinds: list[T.DataType]) -> T.DataType:
    """The type that holds the values of all: itself, double for different numbers, else text."""
    if all(kind == kinds[0] for kind in kinds):
        return kinds[0]
    return T.DoubleType() if all(isinstance(kind, T.NumericType) for kind in kinds) else T.StringType()


def read_bronze(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    any_folders: bool = False,
    file_column: str | None = None,
    **options,
) -> DataFrame:
    """All CSV files below ``path``, each read by its own header; types inferred unless a schema is given.

    Columns are matched by name: a file without a column has nulls there, whatever the order of its
    columns. Where inferred types differ between headers, numbers become doubles and other values text.
    A schema sets the types of the columns it names and adds those that no file has.
    ``name=value`` folders become columns, so filters on them skip folders; ``any_folders`` reads every
    sub-folder instead, whatever its name. ``file_column`` adds each row's file.
    """
    parts = []
    wanted = {} if schema is None else {field.name: field.dataType for field in schema.fields}
    for line, files in _headers(spark, path, any_folders, options):
        reader = spark.read.option("header", True).options(**options)
        if not any_folders:
            reader = reader.option("basePath", path)
        names = reader.csv(files[:1]).columns
        if schema is None:
            rows = reader.option("inferSchema", True).csv(files)
        else:
            folders = set(names) - set(next(csv.reader([line], delimiter=options.get("sep", options.get("delimiter", ",")))))
            fields = [T.StructField(name, wanted.get(name, T.StringType())) for name in names if name not in folders]
            rows = reader.schema(T.StructType(fields)).csv(files)
        parts.append(rows.withColumn(file_column, F.col("_metadata.file_path")) if file_column else rows)
    if not parts:
        raise FileNotFoundError(f"no CSV files below {path}")
    kinds: dict[str, list[T.DataType]] = {}
    for part in parts:
        for field in part.schema.fields:
            kinds.setdefault(field.name, []).append(field.dataType)
    for name, kind in wanted.items():
        kinds.setdefault(name, [kind])
    whole = [
        part.select(*[F.col(f"`{n}`").cast(_one_type(k)).alias(n) if n in part.columns else F.lit(None).cast(_one_type(k)).alias(n) for n, k in kinds.items()])
        for part in parts
    ]
    return reduce(DataFrame.unionByName, whole)


def csv_to_parquet(
    spark: SparkSession, source: str, target: str, schema: T.StructType | None = None, **options
) -> bool:
    """Convert every CSV file below ``source`` to snappy Parquet in one job, each by its own header.

    ``rel_dir`` (a partition column) keeps the sub-folder of each row and
    ``source_file`` its file. Files with a header only add their columns. Returns False, with a log
    line, when there is no CSV file; any other error is raised.
    """
    try:
        rows = read_bronze(spark, source, schema, any_folders=True, file_column="source_file", **options)
    except (AnalysisException, FileNotFoundError) as error:
        if isinstance(error, AnalysisException) and error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no CSV files below %s: %s", source, error)
        return False
    folder = spark._jvm.org.apache.hadoop.fs.Path(source)
    qualified = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder)
    root = qualified.toUri().getPath().strip("/")
    # File paths come as URIs: blanks are encoded, a plus sign is not.
    file = F.url_decode(F.replace("source_file", F.lit("+"), F.lit("%2B")))
    start = F.instr(file, f"/{root}/")
    outside = F.raise_error(F.concat(F.lit("file outside the source folder: "), file)).cast("string")
    relative = F.when(start > 0, F.substr(file, start + len(root) + 2)).otherwise(outside)
    placed = rows.withColumns({"source_file": file, "rel_dir": F.regexp_replace(relative, "/?[^/]*$", "")})
    (
        placed.hint("rebalance", F.col("rel_dir"))
        .write.mode("overwrite")
        .partitionBy("rel_dir")
        .option("compression", "snappy")
        .parquet(target)
    )
    return True


def write_bronze(df: DataFrame, path: str, crypto: str, years: Sequence[int] | None = None) -> None:
    """Bars as CSV, one folder per crypto, year and two-digit month; ``years`` leaves other rows out."""
    layered = add_layer_columns(df, crypto)
    if years is not None:
        layered = layered.filter(F.col("year").isin(*years))
    folders = layered.withColumn("month", F.lpad(F.col("month").cast("string"), 2, "0"))
    writer = _by_folder(folders, LAYER_PARTITIONS).write.mode("overwrite").partitionBy(*LAYER_PARTITIONS)
    writer.options(**CSV_WRITE).csv(path)


def write_layer(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partitions: Sequence[str] = tuple(LAYER_PARTITIONS),
    replace_found_only: bool = False,
) -> None:
    """Parquet in ``name=value`` folders.

    ``replace_found_only`` overwrites just the folders that ``df`` has rows for.
    """
    writer = _by_folder(df, partitions).write.mode(mode).partitionBy(*partitions)
    if replace_found_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _by_folder(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Few files per folder: adaptive execution merges small folders' rows and splits large ones'."""
    inside = [name for name in ("symbol", "datetime") if name in df.columns]
    return df.hint("rebalance", *[F.col(name) for name in partitions]).sortWithinPartitions(*partitions, *inside)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_WRITE).csv(path)


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"`{database}`.`{table}`")


def register_layer(
    spark: SparkSession,
    database: str,
    table: str,
    path: str,
    file_format: str = "parquet",
    partitions: Sequence[str] = tuple(LAYER_PARTITIONS),
    database_path: str | None = None,
    **options,
) -> DataFrame:
    """Make sure database and table exist over a folder, and add folders that came since.

    The table keeps the columns it was created with; :func:`schema_drift` tells
    what the files have by now.
    """
    place = f" LOCATION '{database_path}'" if database_path else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{place}")
    name = f"`{database}`.`{table}`"
    if not spark.catalog.tableExists(f"{database}.{table}"):
        fields = spark.read.format(file_format).options(**options).load(path).schema.fields
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        extra = ", ".join(f"'{key}' '{value}'" for key, value in options.items())
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {file_format}"
            + (f" OPTIONS ({extra})" if extra else "")
            + (f" PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else "")
            + f" LOCATION '{path}'"
        )
    if partitions:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return read_table(spark, database, table)


def schema_drift(spark: SparkSession, found: T.StructType, registered: T.StructType) -> DataFrame:
    """Columns that the files have and the table lacks, or the other way round, or with another type."""
    old = {field.name: field.dataType.simpleString() for field in registered.fields}
    new = {field.name: field.dataType.simpleString() for field in found.fields}
    rows = []
    for name in sorted(old | new):
        before, after = old.get(name), new.get(name)
        if before != after:
            change = "added" if before is None else "removed" if after is None else "type"
            rows.append((name, change, before, after))
    return spark.createDataFrame(rows, "column string, change string, old_type string, new_type string")
