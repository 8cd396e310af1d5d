"""Appending to, upserting into and overwriting date-partitioned Parquet tables.

Upserts rewrite only the date partitions that receive staged rows. Replacing
partitions is not one atomic step and assumes a single writer.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperlake import schema
from paperlake.operators.dedup import best_per_key
from paperlake.operators.merge import merge
from paperlake.session import materialize
from paperlake.settings import CODEC, Source
from paperlake.sources.records import table_or_none

_DATE = list(schema.PARTITION_COLUMNS)
# What a record is known by.
_KNOWN_BY = ["id", "source", "record_hash"]
# Bytes of text that a task gathers of one date, about; a date with more is dealt to several.
CELL_BYTES = 128 * 1024 * 1024
# A record with more copies in a batch has them collapsed in the map tasks.
HOT_COPIES = 1000
# Of a batch with at most as many new records, some 150 bytes each, only theirs are shuffled.
SHIPPED_RECORDS = 100_000


def _by_date(df: DataFrame) -> DataFrameWriter:
    """A writer partitioned by year, month and day."""
    return df.write.partitionBy(*_DATE).option("compression", CODEC)


def _gathered(df: DataFrame) -> DataFrame:
    """Each date gathered into files of the advisory size.

    A date that holds a large share of the rows is split over several tasks.
    """
    return df.hint("rebalance", *_DATE)


def append_by_date(df: DataFrame, path: str) -> None:
    """Append rows that lie together by date already."""
    _by_date(df).mode("append").parquet(path)


def replace_dates(df: DataFrame, path: str) -> None:
    """Replace exactly the date partitions that occur in ``df``; leave the others alone."""
    _by_date(_gathered(df)).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def replace_all(df: DataFrame, path: str) -> None:
    """Replace the whole table."""
    _by_date(_gathered(df)).mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def append_new_records(
    spark: SparkSession, records: DataFrame, path: str, prune: bool = False, told: DataFrame | None = None
) -> None:
    """Append the records the raw table does not hold yet, so that a rerun adds nothing.

    A record is known by id, source and content; of equal ones the first landed is
    stored. Equal records have one date, so a batch is shuffled once, by date, with three
    narrow columns of the stored table beside it; what is new is written from there. A
    date of many bytes is dealt to cells by hash. ``prune`` reads the stored columns only
    from the date partitions the batch falls into. ``told`` is the batch's stored
    ``_counted`` outline, if there is one.
    """
    names = schema.raw_table_schema().names
    records = records.select(*names)
    told = _counted(outline(records)) if told is None else told
    # A batch has at most one such record per HOT_COPIES rows; of each, a map task sends one row.
    many = F.col("copies") > HOT_COPIES
    hot = materialize(told.filter(many).select(*_KNOWN_BY), "hot-records")
    cells = _cells(told.withColumn("text_bytes", F.when(many, 0).otherwise(F.col("text_bytes"))))
    batch = _collapsed(records, hot).withColumn("_new", F.lit(1))
    stored = table_or_none(spark, path, schema.raw_table_schema())
    if stored is not None:
        if prune:
            stored = only_touched(stored, cells)
        known = stored.select(*_KNOWN_BY, *_DATE).distinct().withColumn("_new", F.lit(0))
        # An anti join would shuffle the batch once more, by other columns.
        batch = batch.unionByName(known, allowMissingColumns=True)
    dealt = _dealt(batch, cells)
    equal = Window.partitionBy(*_DATE, "_cell", *_KNOWN_BY).orderBy("_new", *_first_landed())
    fresh = dealt.withColumn("_before", F.lag("_new").over(equal)).filter("_before is null and _new = 1")
    append_by_date(fresh.select(*names), path)


def append_outlined_records(
    spark: SparkSession, records: DataFrame, outlined: DataFrame, path: str, prune: bool = False
) -> None:
    """``append_new_records`` of records whose ``outline`` is stored: texts move only if they may be new.

    The outline is compared with the stored table first. A batch that holds nothing new is
    not looked at again. Of few new records the keys are shipped to the map tasks, which
    drop the others there. Of more, the dates are shipped, and known records of those
    dates are dropped behind the shuffle.
    """
    told = _counted(outlined)
    stored = table_or_none(spark, path, schema.raw_table_schema())
    if stored is not None:
        known = only_touched(stored, outlined) if prune else stored
        told = _joined(told, known.select(*_KNOWN_BY), "left_anti")
    told = materialize(told, "new-records", CODEC)
    if stored is not None:
        new = told.count()
        if not new:
            return
        by = _KNOWN_BY if new <= SHIPPED_RECORDS else _DATE
        records = _joined(records, F.broadcast(told.select(*by).distinct()), "left_semi", by)
    append_new_records(spark, records, path, prune, told)


def outline(records: DataFrame) -> DataFrame:
    """What an append needs of records before it moves texts: by what they are known, date, bytes of text."""
    text = F.octet_length(F.concat_ws("", *schema.CLEANED_FIELDS)).cast("bigint")
    return records.select(*_KNOWN_BY, *_DATE, text.alias("text_bytes"))


def _counted(outlined: DataFrame) -> DataFrame:
    """A row per record: how many copies it has, and their bytes of text together."""
    copies = F.count(F.lit(1)).alias("copies")
    return outlined.groupBy(*_KNOWN_BY, *_DATE).agg(copies, F.sum("text_bytes").alias("text_bytes"))


def _joined(records: DataFrame, others: DataFrame, how: str, by: Sequence[str] = _KNOWN_BY) -> DataFrame:
    """Records joined with others by what records are known by, or by date; nulls are equal."""
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in by]
    return records.alias("r").join(others.alias("o"), same, how)


def _first_landed() -> list[Column]:
    return [F.col("landed_at").asc_nulls_last(), F.col("pdf_s3_path").asc()]


def _dealt(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """The rows shuffled by date and ``_cell``; as many dates at most as days, see ``only_touched``."""
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"c.{c}")) for c in _DATE]
    cell = F.pmod("record_hash", F.coalesce("cells", F.lit(1))).alias("_cell")
    found = rows.alias("r").join(F.broadcast(cells).alias("c"), same, "left").select("r.*", cell)
    return found.repartition(*_DATE, "_cell")


def best_by_date(papers: DataFrame, sources: Iterable[Source]) -> DataFrame:
    """What ``best_per_key`` keeps of raw-table rows, lying together by date.

    The best are found among narrow columns, and meet their texts where these are
    shuffled by date: once, where a dedup by id needs another shuffle before it is written.
    """
    told_by = [*_KNOWN_BY, "landed_at"]
    best = best_per_key(papers.select(*told_by, *_DATE), sources).withColumn("_wide", F.lit(0))
    both = papers.withColumn("_wide", F.lit(1)).unionByName(best, allowMissingColumns=True)
    equal = Window.partitionBy(*_DATE, "_cell", *told_by).orderBy("_wide", F.col("pdf_s3_path").asc())
    dealt = _dealt(both, _cells(outline(papers))).withColumn("_before", F.lag("_wide").over(equal))
    return dealt.filter("_before = 0 and _wide = 1").select(*papers.columns)


def _cells(told: DataFrame) -> DataFrame:
    """A batch's dates and the number of cells each is dealt to, written first, so that Spark knows its size."""
    cells = F.greatest(F.ceil(F.sum("text_bytes") / CELL_BYTES), F.lit(1)).alias("cells")
    return materialize(told.groupBy(*_DATE).agg(cells), "batch-dates")


def _collapsed(records: DataFrame, hot: DataFrame) -> DataFrame:
    """The records, those of many copies as one row each.

    All copies of a record meet in one task. Of many, each map task sends one, ordered by
    narrow columns.
    """
    hot = F.broadcast(hot)
    rest = _joined(records, hot, "left_anti")
    # Without such records, Spark drops this half when it finds the shipped table empty.
    copies = _joined(records, hot, "left_semi")
    first = Window.partitionBy(*_KNOWN_BY).orderBy(*_first_landed())
    copies = copies.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")
    return rest.unionByName(copies)


def only_touched(target: DataFrame, papers: DataFrame) -> DataFrame:
    """Target rows in the date partitions that occur in ``papers``, and rows without a date.

    Undated rows share one partition; they come along so that replacing it loses none.
    The distinct dates are shipped, which is bounded: the date type has 3.7 million days,
    44 MB in all. Spark prunes the target's partitions by the shipped dates at run time,
    in the same job, so others are not read.
    """
    dates = papers.select(*_DATE).filter("month between 1 and 12").distinct()
    dated = target.join(F.broadcast(dates), _DATE, "left_semi")
    return dated.unionByName(target.filter("year is null"))


def window_folders(spark: SparkSession, path: str, start: dt.date) -> list[str]:
    """The date folders of a table from ``start`` on, listed year by year, month by month.

    Folders of earlier years and months are not opened, nor is the undated one.
    """
    jvm = spark.sparkContext._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(conf)

    def below(folder, level: int, wanted: tuple[int, ...]) -> list[tuple[tuple[int, ...], object]]:
        found = []
        for status in files.listStatus(folder):
            match = re.fullmatch(rf"{_DATE[level]}=(\d+)", status.getPath().getName())
            if match and (*wanted, int(match[1])) >= (start.year, start.month, start.day)[: level + 1]:
                found.append(((*wanted, int(match[1])), status.getPath()))
        return found

    folders: list[tuple[tuple[int, ...], object]] = [((), root)]
    for level in range(len(_DATE)):
        folders = [f for values, folder in folders for f in below(folder, level, values)]
    return sorted(folder.toString() for _, folder in folders)


def read_since(spark: SparkSession, path: str, table_schema: StructType, start: dt.date) -> DataFrame:
    """A date-partitioned table's rows from ``start`` on; only folders of those dates are listed."""
    folders = window_folders(spark, path, start)
    if not folders:
        return spark.createDataFrame([], table_schema)
    return spark.read.schema(table_schema).option("basePath", path).parquet(*folders)


def upsert_by_date(
    spark: SparkSession,
    staging: DataFrame,
    path: str,
    undeduplicated: DataFrame | None = None,
    dated: DataFrame | None = None,
) -> None:
    """Merge deduplicated staged rows into the table at ``path``, creating it if absent.

    Untouched partitions are neither read nor rewritten. Pass the rows from
    before the dedup as ``undeduplicated`` to find the dates without running it, and the
    staged rows lying together by date as ``dated`` to create the table from those.
    """
    target = table_or_none(spark, path, schema.master_schema())
    if target is None and dated is not None:
        append_by_date(dated.select(*schema.MASTER_TABLE_COLUMNS), path)
        return
    if target is None:
        append_by_date(_gathered(staging.select(*schema.MASTER_TABLE_COLUMNS)), path)
        return
    affected = only_touched(target, staging if undeduplicated is None else undeduplicated)
    replace_dates(merge(affected, staging), path)
