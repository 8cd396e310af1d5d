"""Reading landed record files and bringing them to the paper schema."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperlake import schema
from paperlake.functions.identity import paper_id, pdf_object_path
from paperlake.settings import CODEC

RECORD_FORMATS = ("parquet", "json")
# True where a line of a record file could not be parsed; such a record is all null.
MALFORMED = "_malformed"
# Footers of other writers' files that the driver reads at a time.
FOOTER_THREADS = 32


def _checked_format(fmt: str) -> str:
    if fmt not in RECORD_FORMATS:
        raise ValueError(f"Unsupported file format: {fmt}")
    return fmt


def read_records(
    spark: SparkSession, path: str, fmt: str = "parquet", record_schema: T.StructType | None = None
) -> DataFrame:
    """All record files of one format anywhere below ``path``.

    Landed files sit in dated subfolders, so the listing descends. With
    ``record_schema`` files are read under it and a column a file lacks reads as null.
    Without, columns come as text whatever their files hold: Parquet files of other
    writers may have dates, timestamps, or a placeholder type where all values are null.
    """
    if record_schema is not None:
        return _reader(spark, fmt, record_schema).load(path)
    if _checked_format(fmt) == "json":
        return read_lines(spark, [path]).drop(MALFORMED)
    return read_typed_files(spark, [r["path"] for r in _files(spark, path, fmt).collect()])


def _reader(spark: SparkSession, fmt: str, record_schema: T.StructType) -> DataFrameReader:
    reader = spark.read.format(_checked_format(fmt)).schema(record_schema)
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", file_names(fmt))


def file_names(fmt: str) -> str:
    """The pattern of a format's file names; JSON lines may be compressed by gzip."""
    return "*.json{,.gz}" if fmt == "json" else f"*.{fmt}"


def _files(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """The names of record files, which a scan needs on the driver anyway; no content is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", file_names(fmt)).load(path).select("path")


def read_files(spark: SparkSession, paths: list[str], fmt: str) -> DataFrame:
    """The given record files, columns as text, and whether a record was malformed."""
    if _checked_format(fmt) == "json":
        return read_lines(spark, paths)
    return read_typed_files(spark, paths).withColumn(MALFORMED, F.lit(False))


def read_folder(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """All record files below ``path``, columns as text, and whether a record was malformed."""
    if _checked_format(fmt) == "json":
        return read_lines(spark, [path])
    return read_records(spark, path, fmt).withColumn(MALFORMED, F.lit(False))


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """JSON-lines files or folders of them; a line that cannot be parsed is marked and all null."""
    unparsed = "_unparsed"
    columns = T.StructType([*schema.raw_schema(), T.StructField(unparsed, T.StringType())])
    rows = _reader(spark, "json", columns).option("columnNameOfCorruptRecord", unparsed).load(paths)
    return rows.select(*schema.raw_schema().names, F.col(unparsed).isNotNull().alias(MALFORMED))


def read_typed_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Parquet files of any column types, columns as text; only their footers are read here.

    Spark's own job compares the footers. If all agree, one scan reads the files. If a
    column has different types in different files, files of one schema are scanned
    together, and each scan is cast to text.
    """
    if not paths:
        return spark.createDataFrame([], schema.raw_schema())
    try:
        return conform(spark.read.option("mergeSchema", "true").parquet(*paths))
    except (PySparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    groups: dict[str, list[str]] = defaultdict(list)
    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        for path, kind in zip(paths, pool.map(lambda p: _footer_schema(spark, p), paths)):
            groups[kind].append(path)
    return union_papers([conform(spark.read.parquet(*sorted(groups[kind]))) for kind in sorted(groups)])


def _footer_schema(spark: SparkSession, path: str) -> str:
    """A Parquet file's schema as its footer has it, read through the storage's file system."""
    jvm, conf = spark.sparkContext._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    parquet = jvm.org.apache.parquet.hadoop
    name = jvm.org.apache.hadoop.fs.Path(path)
    reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(name, conf))
    try:
        return reader.getFileMetaData().getSchema().toString()
    finally:
        reader.close()


def write_records(df: DataFrame, path: str, run_date: dt.date, fmt: str = "parquet") -> None:
    """Append raw records below ``path/yyyy/MM/dd``, always with the full declared schema.

    An empty frame writes no rows. Columns that are null in every row keep their
    string type, so the files stay readable. Files are compressed, JSON lines by gzip.
    """
    writer = conform(df).write.mode("append").format(_checked_format(fmt))
    writer = writer.option("compression", "gzip" if fmt == "json" else CODEC)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.save(f"{path}/{run_date:%Y/%m/%d}")


def conform(df: DataFrame) -> DataFrame:
    """The raw columns in declared order, as strings; absent ones become null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast("string").alias(f.name)
            for f in schema.raw_schema()
        ]
    )


def map_fields(df: DataFrame, mapping: Mapping[str, str], source: str) -> DataFrame:
    """Rename provider columns to the canonical ones and tag the source.

    ``mapping`` goes from provider column to canonical column. Canonical columns
    that are neither mapped nor present become null; a source value in the data is
    replaced.
    """
    given = {wanted: name for name, wanted in mapping.items() if name in df.columns}
    own = [c for c in df.columns if c not in mapping and c not in given]
    renamed = df.select(*own, *[F.col(name).alias(wanted) for wanted, name in given.items()])
    return conform(renamed).withColumn("source", F.lit(source))


def prepare_records(
    df: DataFrame, bucket: str, run_date: dt.date, ingested_at: Column | None = None
) -> DataFrame:
    """Give raw records their id, PDF object path and ingestion stamp."""
    with_id = conform(df).withColumn("id", paper_id(*map(F.col, ("title", "authors", "publication_date"))))
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return with_id.withColumns(
        {
            "pdf_s3_path": pdf_object_path(
                bucket, F.col("source"), F.lit(run_date), F.col("id"), F.col("pdf_url")
            ),
            "ingestion_timestamp": F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        }
    )


def to_papers(raw: DataFrame, source: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Typed paper rows from raw records; text that is no date or time becomes null.

    A record without an id gets the one its raw text hashes to, before any cast.
    ``source`` replaces whatever source the records name; ``keep`` carries other
    columns along.
    """
    hashed = paper_id(F.col("title"), F.col("authors"), F.col("publication_date"))
    values = {"id": F.coalesce("id", hashed)}
    if source is not None:
        values["source"] = F.lit(source)
    columns = [
        values.get(name, F.col(name) if kind == "string" else F.col(name).try_cast(kind)).alias(name)
        for name, kind in schema.PAPER_FIELDS
    ]
    return raw.select(*keep, *columns)


def union_papers(frames: Iterable[DataFrame]) -> DataFrame:
    """Bag union by column name; a column missing on one side becomes null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def table_or_none(spark: SparkSession, path: str, table_schema: T.StructType) -> DataFrame | None:
    """The Parquet table at ``path``, or None when nothing was written there yet."""
    try:
        return spark.read.schema(table_schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
