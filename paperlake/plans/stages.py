"""The stages of the lake: land records, refine them, load vectors, check the outputs."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from paperlake import schema
from paperlake.functions.dates import first_day
from paperlake.functions.sql import register_functions
from paperlake.operators.dedup import best_per_key
from paperlake.operators.embed import Encoder, build_points, hashing_encoder, refreshed_points
from paperlake.operators.refine import recent
from paperlake.plans.tables import (
    best_by_date,
    only_touched,
    read_since,
    replace_all,
    replace_dates,
    upsert_by_date,
)
from paperlake.settings import LakeSettings, Source
from paperlake.sources.records import (
    map_fields,
    prepare_records,
    read_folder,
    table_or_none,
    union_papers,
    write_records,
)
from paperlake.streaming.landing import append_refined, ingest_new_files

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class SourceStatus:
    """How a source came through the refinement: rows read, unreadable, kept by the rules and newly stored."""

    source: str
    state: str  # loaded, disabled, empty or failed
    detail: str = ""
    rows_read: int = 0
    rows_malformed: int = 0
    rows_kept: int = 0
    rows_stored: int = 0


def land_records(
    spark: SparkSession,
    settings: LakeSettings,
    records: Mapping[str, DataFrame],
    bucket: str,
    run_date: dt.date,
) -> None:
    """Write each source's records, under canonical names, to its landing folder."""

    def one(name: str) -> None:
        mapped = map_fields(records[name], settings.field_mappings.get(name, {}), name)
        prepared = prepare_records(mapped, bucket, run_date)
        write_records(prepared, settings.landing_path(name), run_date, settings.source(name).format)

    with ThreadPoolExecutor(max(1, len(records))) as pool:
        list(pool.map(one, records))


def refine_sources(
    spark: SparkSession,
    settings: LakeSettings,
    stamp: Column | None = None,
    incremental: bool = True,
) -> list[SourceStatus]:
    """Append every enabled source's new papers to its raw table.

    A source that cannot be read or written is reported and skipped; the others
    go on. By default only files landed since the last run are read; otherwise
    everything landed is compared with everything stored. All sources of a run get
    one stamp.
    """
    stamp = F.lit(dt.datetime.now(dt.timezone.utc)) if stamp is None else stamp

    def one(source: Source) -> SourceStatus:
        if not source.enabled:
            return SourceStatus(source.name, "disabled")
        try:
            before = _stored_rows(spark, settings, source)
            if incremental:
                done = ingest_new_files(spark, settings, source, settings.checkpoint_path(source.name), stamp)
            else:
                raw = read_folder(spark, settings.landing_path(source.name), source.format)
                done = append_refined(spark, settings, source, raw, stamp, prune=False)
            after = _stored_rows(spark, settings, source)
            state = "loaded" if after else "empty"
            return SourceStatus(source.name, state, "", done.read, done.malformed, done.kept, after - before)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return SourceStatus(source.name, "empty", "nothing was ever landed")
            return _failed(source, error)
        except Exception as error:  # any failure of one source must not stop the rest
            return _failed(source, error)

    # The sources' jobs are independent; submitted together they fill the cluster.
    with ThreadPoolExecutor(len(settings.sources)) as pool:
        return list(pool.map(one, settings.sources))


def _failed(source: Source, error: Exception) -> SourceStatus:
    log.error("source %s failed", source.name, exc_info=error)
    return SourceStatus(source.name, "failed", f"{type(error).__name__}: {error}")


def _stored_rows(spark: SparkSession, settings: LakeSettings, source: Source) -> int:
    """Rows of a raw table, which the file footers tell."""
    stored = table_or_none(spark, settings.raw_table_path(source.name), schema.raw_table_schema())
    return 0 if stored is None else stored.count()


def recent_papers(
    spark: SparkSession, settings: LakeSettings, sources: Iterable[str], as_of: dt.date | None
) -> DataFrame:
    """Papers of the given sources inside the lookback window.

    They come from the raw tables, which hold cleaned rows by date: only folders of the
    window are listed, and nothing is cleaned twice.
    """
    days = settings.lookback_days
    start = first_day(spark, as_of, days)
    frames = [read_since(spark, settings.raw_table_path(name), schema.raw_table_schema(), start) for name in sources]
    return recent(union_papers(frames), as_of, days)


def stage_papers(papers: DataFrame, settings: LakeSettings, stamp: Column | None = None) -> DataFrame:
    """One row per id in master columns, stamped with one ingestion time."""
    stamp = F.current_timestamp() if stamp is None else stamp
    best = best_per_key(papers, settings.sources)
    return best.withColumn("ingestion_timestamp", stamp).select(*schema.MASTER_TABLE_COLUMNS)


def refine_stage(
    spark: SparkSession,
    settings: LakeSettings,
    as_of: dt.date | None = None,
    stamp: Column | None = None,
    incremental: bool = True,
) -> list[SourceStatus]:
    """Landed files to raw tables, then the recent papers into the master table."""
    stamp = F.lit(dt.datetime.now(dt.timezone.utc)) if stamp is None else stamp
    report = refine_sources(spark, settings, stamp, incremental)
    loaded = [s.source for s in report if s.state == "loaded"]
    if loaded:
        papers = recent_papers(spark, settings, loaded, as_of)
        staging = stage_papers(papers, settings, stamp)
        staging.createOrReplaceTempView("staging_papers")
        register_functions(spark)
        missing = table_or_none(spark, settings.master_path, schema.master_schema()) is None
        dated = best_by_date(papers, settings.sources).withColumn("ingestion_timestamp", stamp) if missing else None
        upsert_by_date(spark, staging, settings.master_path, undeduplicated=papers, dated=dated)
    return report


def vector_stage(
    spark: SparkSession,
    settings: LakeSettings,
    make_encoder: Callable[[], Encoder] | None = None,
    touched: DataFrame | None = None,
) -> None:
    """Encode the master table into the vector table.

    Without ``touched`` the whole table is encoded and replaced. With it, only the date
    partitions that occur in its rows (year, month, day) are replaced, which is what an
    upsert of those papers needs, and only papers whose text changed are encoded; the
    others keep their vectors. After a change of encoder, encode the whole table.
    """
    master = table_or_none(spark, settings.master_path, schema.master_schema())
    if master is None:
        log.warning("no master table to encode")
        return
    encoder = make_encoder or hashing_encoder(settings.vector_dim)
    stored = table_or_none(spark, settings.vectors_path, schema.points_schema())
    if touched is None:
        replace_all(build_points(master, encoder), settings.vectors_path)
    elif stored is None:
        replace_dates(build_points(only_touched(master, touched), encoder), settings.vectors_path)
    else:
        points = refreshed_points(only_touched(stored, touched), only_touched(master, touched), encoder)
        replace_dates(points, settings.vectors_path)


def table_checks(raw: DataFrame, master: DataFrame, points: DataFrame) -> DataFrame:
    """``check_name, passed`` for the outputs of the three stages.

    Presence checks stop at the first row; the completeness checks compare ids only.
    """

    def present(df: DataFrame) -> DataFrame:
        return df.limit(1).agg(F.count("*") > 0)

    def none(df: DataFrame) -> DataFrame:
        return df.limit(1).agg(F.count("*") == 0)

    repeated = master.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
    unencoded = master.select("id").join(points.select("id"), "id", "left_anti")
    checks = {
        "raw_data_found": present(raw),
        "master_found": present(master),
        "vectors_found": present(points),
        "master_ids_unique": none(repeated),
        "vectors_complete": none(unencoded),
    }
    rows = [df.toDF("passed").select(F.lit(name).alias("check_name"), "passed") for name, df in checks.items()]
    return union_papers(rows)


def status_checks(spark: SparkSession, report: Iterable[SourceStatus]) -> DataFrame:
    """One check per source: it did not fail. The rows say what came of it."""
    rows = [(f"source_{s.source}", s.state != "failed", s.state, s.detail, s.rows_read, s.rows_malformed, s.rows_kept, s.rows_stored) for s in report]
    return spark.createDataFrame(
        rows,
        "check_name string, passed boolean, state string, detail string, "
        "rows_read long, rows_malformed long, rows_kept long, rows_stored long",
    )


def check_stage(
    spark: SparkSession, settings: LakeSettings, report: Iterable[SourceStatus] | None = None
) -> DataFrame:
    """The checks over the lake's tables as stored, and over a run's report; a missing table counts as empty."""

    def stored(path: str, table_schema: StructType) -> DataFrame:
        found = table_or_none(spark, path, table_schema)
        return spark.createDataFrame([], table_schema) if found is None else found

    raw = [stored(settings.raw_table_path(s.name), schema.raw_table_schema()) for s in settings.enabled_sources]
    checks = table_checks(
        union_papers(raw),
        stored(settings.master_path, schema.master_schema()),
        stored(settings.vectors_path, schema.points_schema()),
    )
    return checks if report is None else union_papers([status_checks(spark, report), checks])


def run_all(
    spark: SparkSession,
    settings: LakeSettings,
    records: Mapping[str, DataFrame],
    bucket: str,
    run_date: dt.date,
    as_of: dt.date | None = None,
    make_encoder: Callable[[], Encoder] | None = None,
    incremental: bool = True,
) -> DataFrame:
    """All stages in order; returns the output checks with each source's state and row counts.

    By default a run reads the files landed since the last one, restages the papers of
    the lookback window and encodes the dates that those touch. ``incremental=False``
    reads and encodes everything.
    """
    land_records(spark, settings, records, bucket, run_date)
    report = refine_stage(spark, settings, as_of, incremental=incremental)
    loaded = [s.source for s in report if s.state == "loaded"]
    if loaded and incremental:
        touched = recent_papers(spark, settings, loaded, as_of).select(*schema.PARTITION_COLUMNS)
        vector_stage(spark, settings, make_encoder, touched)
    else:
        vector_stage(spark, settings, make_encoder)
    return check_stage(spark, settings, report)
