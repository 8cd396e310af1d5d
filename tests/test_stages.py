from __future__ import annotations

import datetime as dt
import glob
import os
import re
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperlake import schema
from paperlake.plans import stages, tables
from paperlake.settings import LakeSettings
from paperlake.sources.records import read_records
from paperlake.sources.samples import SAMPLE_RECORDS, sample_records
from paperlake.streaming import landing
from tests.plans import plan_of

DAY = dt.date(2024, 1, 16)


@pytest.fixture
def lake(folder):
    return LakeSettings(f"{folder}/lake", vector_dim=32)


def land(spark, lake, *names):
    stages.land_records(spark, lake, {n: sample_records(spark, n) for n in names}, "bucket", DAY)


def master(spark, lake):
    return spark.read.schema(schema.master_schema()).parquet(lake.master_path)


def points(spark, lake):
    return spark.read.schema(schema.points_schema()).parquet(lake.vectors_path)


def test_full_run_passes_its_checks(spark, lake):
    records = {n: sample_records(spark, n) for n in SAMPLE_RECORDS}
    checks = stages.run_all(spark, lake, records, "bucket", DAY, DAY)
    sources = [f"source_{s.name}" for s in lake.sources]
    assert {r["check_name"]: r["passed"] for r in checks.collect()} == dict.fromkeys(
        ["raw_data_found", "master_found", "vectors_found", "master_ids_unique", "vectors_complete", *sources], True
    )
    told = {r["check_name"]: (r["state"], r["rows_read"], r["rows_kept"], r["rows_stored"]) for r in checks.collect()}
    assert told["source_arxiv"] == ("loaded", 2, 2, 2) and told["source_springer"] == ("disabled", 0, 0, 0)
    assert told["source_ieee"] == ("empty", 0, 0, 0)
    assert master(spark, lake).count() == 3
    (p,) = points(spark, lake).filter("payload.source = 'pubmed'").collect()
    assert p["id"] == p["payload"]["id"] and len(p["vector"]) == 32
    assert p["payload"]["publication_date"] == dt.date(2024, 1, 10)
    assert spark.table("staging_papers").columns == list(schema.MASTER_TABLE_COLUMNS)


def test_empty_lake_fails_its_presence_checks(spark, lake):
    stages.vector_stage(spark, lake)
    checks = stages.check_stage(spark, lake)
    assert {r["check_name"] for r in checks.filter("not passed").collect()} == {
        "raw_data_found", "master_found", "vectors_found",
    }


def test_each_source_lands_in_its_format(spark, lake):
    land(spark, lake, "arxiv", "pubmed")
    assert read_records(spark, lake.landing_path("arxiv"), "parquet").count() == 2
    assert read_records(spark, lake.landing_path("pubmed"), "json").count() == 1


def test_landing_maps_provider_columns(spark, lake):
    lake = replace(lake, field_mappings={"ieee": {"name": "title"}})
    df = sample_records(spark, "arxiv").withColumnRenamed("title", "name").drop("full_text")
    stages.land_records(spark, lake, {"ieee": df}, "bucket", DAY)
    rows = read_records(spark, lake.landing_path("ieee"), "parquet").collect()
    assert {r["title"] for r in rows} == {x["title"] for x in SAMPLE_RECORDS["arxiv"]}
    assert all(r["source"] == "ieee" and r["pdf_s3_path"].startswith("s3://bucket/raw_pdfs/ieee/") for r in rows)


@pytest.mark.parametrize("incremental", [False, True])
def test_sources_fail_alone(spark, lake, incremental):
    land(spark, lake, "arxiv", "pubmed")
    short = sample_records(spark, "arxiv").withColumns({"title": F.lit("short"), "source": F.lit("acm")})
    stages.land_records(spark, lake, {"acm": short}, "bucket", DAY)
    broken = f"{lake.landing_path('ieee')}/2024/01/16"
    os.makedirs(broken)
    with open(f"{broken}/bad.parquet", "w") as f:
        f.write("not parquet")
    report = {s.source: s.state for s in stages.refine_stage(spark, lake, DAY, incremental=incremental)}
    assert report == {
        "arxiv": "loaded", "pubmed": "loaded", "ieee": "failed", "acm": "empty", "springer": "disabled",
    }
    assert master(spark, lake).count() == 3


def test_missing_landing_folders_are_reported(spark, lake):
    report = stages.refine_stage(spark, lake, DAY)
    assert {s.state for s in report} == {"empty", "disabled"}
    assert not os.path.exists(lake.master_path)


@pytest.mark.parametrize("incremental", [False, True])
def test_rerun_adds_nothing_and_new_files_are_merged(spark, lake, incremental):
    land(spark, lake, "arxiv")
    stages.refine_stage(spark, lake, DAY, incremental=incremental)
    stages.refine_stage(spark, lake, DAY, incremental=incremental)
    raw = spark.read.parquet(lake.raw_table_path("arxiv"))
    assert raw.count() == 2 and master(spark, lake).count() == 2
    with_doi = sample_records(spark, "arxiv").withColumn("doi", F.lit("10.1000/late"))
    stages.land_records(spark, lake, {"arxiv": with_doi}, "bucket", DAY + dt.timedelta(1))
    stages.refine_stage(spark, lake, DAY, incremental=incremental)
    assert spark.read.parquet(lake.raw_table_path("arxiv")).count() == 4
    assert [r["doi"] for r in master(spark, lake).collect()] == ["10.1000/late"] * 2


@pytest.mark.parametrize("incremental", [False, True])
def test_refetched_records_are_stored_once(spark, lake, incremental):
    for later in range(3):
        stages.land_records(
            spark, lake, {"arxiv": sample_records(spark, "arxiv")}, "bucket", DAY + dt.timedelta(later)
        )
        stages.refine_stage(spark, lake, DAY, incremental=incremental)
    stored = spark.read.parquet(lake.raw_table_path("arxiv")).collect()
    assert len(stored) == 2 and all("/2024/01/16/" in r["pdf_s3_path"] for r in stored)


def test_the_latest_landed_version_wins(spark, lake):
    base = sample_records(spark, "arxiv")
    for later, title, doi in ((0, "the first version", "10.1000/a"), (1, "the second version", None)):
        versions = base.withColumns({"abstract": F.lit(title), "doi": F.lit(doi)})
        stages.land_records(spark, lake, {"arxiv": versions}, "bucket", DAY + dt.timedelta(later))
    stages.refine_stage(spark, lake, DAY)
    assert {r["abstract"] for r in master(spark, lake).collect()} == {"the second version"}


def test_an_id_with_two_dates_is_one_paper(spark, lake):
    base = sample_records(spark, "arxiv").limit(1).withColumn("id", F.lit("own"))
    both = base.unionByName(base.withColumn("publication_date", F.lit("2024-01-13")))
    read_back = f"{lake.landing_path('arxiv')}/own"
    both.write.parquet(read_back)
    stages.refine_stage(spark, lake, DAY)
    assert [r["id"] for r in master(spark, lake).collect()] == ["own"]


def test_a_failed_source_fails_the_checks(spark, lake):
    broken = f"{lake.landing_path('ieee')}/2024/01/16"
    os.makedirs(broken)
    with open(f"{broken}/bad.parquet", "w") as f:
        f.write("not parquet")
    checks = stages.run_all(spark, lake, {"arxiv": sample_records(spark, "arxiv")}, "bucket", DAY, DAY)
    (failed,) = checks.filter("not passed").collect()
    assert failed["check_name"] == "source_ieee" and failed["state"] == "failed" and failed["detail"]


def test_a_second_run_reads_only_new_files(spark, lake):
    arxiv = sample_records(spark, "arxiv")
    stages.run_all(spark, lake, {"arxiv": arxiv}, "bucket", DAY, DAY)
    before = {r["f"] for r in points(spark, lake).select(F.input_file_name().alias("f")).collect()}
    pubmed = sample_records(spark, "pubmed")
    checks = stages.run_all(spark, replace(lake, lookback_days=1), {"pubmed": pubmed}, "bucket", DAY, DAY)
    told = {r["check_name"]: r["rows_read"] for r in checks.collect()}
    assert (told["source_arxiv"], told["source_pubmed"]) == (0, 1)
    after = {r["f"] for r in points(spark, lake).select(F.input_file_name().alias("f")).collect()}
    # Only the date inside the lookback was encoded again.
    assert len(before & after) == 1


def test_lookback_keeps_older_papers_out_of_the_master(spark, lake):
    land(spark, lake, "arxiv", "pubmed")
    stages.refine_stage(spark, replace(lake, lookback_days=3), dt.date(2024, 1, 18))
    assert [r["publication_date"] for r in master(spark, lake).collect()] == [dt.date(2024, 1, 15)]
    assert spark.read.parquet(lake.raw_table_path("pubmed")).count() == 1


def test_lookback_lists_only_the_days_of_its_window(spark, lake):
    land(spark, lake, "arxiv")
    stages.refine_sources(spark, lake)
    recent = stages.recent_papers(spark, lake, ["arxiv"], dt.date(2024, 1, 22))
    plan = plan_of(recent)
    (folder,) = re.findall(r"InMemoryFileIndex.*?\[([^\]]*)\]", plan)
    assert folder.endswith("/tables/arxiv_raw/year=2024/month=1/day=15")
    assert "GreaterThanOrEqual(publication_date,2024-01-15)" in plan
    assert stages.recent_papers(spark, lake, ["arxiv"], dt.date(2024, 2, 22)).isEmpty()


def test_many_landed_files_arrive_in_bounded_batches(spark, lake):
    lake = replace(lake, max_files_per_batch=10)
    for name in ("arxiv", "pubmed"):
        many = sample_records(spark, name).limit(1).crossJoin(spark.range(35).toDF("n"))
        many = many.withColumn("title", F.concat("title", F.lit(" "), "n")).drop("n").repartition(35, "title")
        many.write.format(lake.source(name).format).save(f"{lake.landing_path(name)}/many")
    stages.refine_sources(spark, lake)
    report = {s.source: s for s in stages.refine_sources(spark, lake)}
    for name in ("arxiv", "pubmed"):
        listed = spark.read.parquet(lake.landed_files_path(name)).groupBy("batch").count().collect()
        files = glob.glob(f"{lake.landing_path(name)}/many/*.{lake.source(name).format}")
        assert len(files) > 20 and len(listed) == -(-len(files) // 10)
        assert max(r["count"] for r in listed) == 10 and sum(r["count"] for r in listed) == len(files)
        assert spark.read.parquet(lake.raw_table_path(name)).count() == 35
        assert (report[name].rows_read, report[name].rows_stored) == (0, 0)


@pytest.mark.parametrize("incremental", [False, True])
def test_malformed_lines_are_counted(spark, lake, incremental):
    land(spark, lake, "arxiv")
    path = lake.landing_path("pubmed")
    os.makedirs(path)
    with open(f"{path}/a.json", "w") as f:
        f.write('{"title": "long enough title"}\n{broken\n{"title": "short"}\n\n[]\n')
    report = {s.source: s for s in stages.refine_sources(spark, lake, incremental=incremental)}
    pubmed = report["pubmed"]
    assert (pubmed.rows_malformed, pubmed.rows_kept, pubmed.rows_stored) == (pubmed.rows_read - 2, 1, 1)
    assert pubmed.rows_malformed in (1, 2)
    assert (report["arxiv"].rows_read, report["arxiv"].rows_malformed) == (2, 0)


def test_only_changed_papers_are_encoded(spark, lake, folder):
    seen = f"{folder}/seen"
    os.makedirs(seen)

    class Counting:
        def __call__(self, texts):
            import uuid

            with open(f"{seen}/{uuid.uuid4()}", "w") as f:
                f.write(str(len(texts)))
            return np.full((len(texts), 2), 0.5 + len(os.listdir(seen)), np.float32)

    def encoded():
        return sum(int(open(f"{seen}/{name}").read()) for name in os.listdir(seen))

    base = sample_records(spark, "arxiv")
    stages.run_all(spark, lake, {"arxiv": base}, "bucket", DAY, DAY, make_encoder=Counting)
    assert encoded() == 2
    first = {r["id"]: r["vector"] for r in points(spark, lake).collect()}
    # A new DOI changes the payload, not the text.
    late = base.withColumn("doi", F.lit("10.1000/late"))
    stages.run_all(spark, lake, {"arxiv": late}, "bucket", DAY + dt.timedelta(1), DAY, make_encoder=Counting)
    assert encoded() == 2
    rows = points(spark, lake).collect()
    assert {r["id"]: r["vector"] for r in rows} == first
    assert {r["payload"]["doi"] for r in rows} == {"10.1000/late"}
    ids = F.when(F.col("publication_date") == "2024-01-15", F.lit("a changed abstract")).otherwise(F.col("abstract"))
    changed = late.withColumn("abstract", ids)
    stages.run_all(spark, lake, {"arxiv": changed}, "bucket", DAY + dt.timedelta(2), DAY, make_encoder=Counting)
    assert encoded() == 3
    after = {r["id"]: r["vector"] for r in points(spark, lake).collect()}
    assert sum(after[i] != first[i] for i in first) == 1


def test_sql_users_have_the_rules(spark, lake):
    land(spark, lake, "arxiv", "pubmed")
    stages.refine_stage(spark, lake, DAY)
    (row,) = spark.sql(
        """select count(*) as n, count_if(doi_valid = doi_is_valid(doi)) as same_doi,
             count_if(clean_text(title) = title) as clean,
             count_if(id = paper_id(concat('  ', upper(title)), authors, cast(publication_date as string))) as same_id
           from staging_papers"""
    ).collect()
    assert tuple(row) == (3, 3, 3, 3)


def test_vector_stage_replaces_all_or_only_recent_dates(spark, lake):
    records = {n: sample_records(spark, n) for n in SAMPLE_RECORDS}
    stages.run_all(spark, lake, records, "bucket", DAY, DAY)

    def files():
        return {r["f"]: r["id"] for r in points(spark, lake).select("id", F.input_file_name().alias("f")).collect()}

    before = files()
    stages.vector_stage(spark, lake, touched=master(spark, lake).filter("day = 15"))
    after = files()
    assert sorted(before.values()) == sorted(after.values())
    assert len(before.keys() & after.keys()) == 2
    stages.vector_stage(spark, lake)
    assert not files().keys() & after.keys()


def test_checks_see_a_missing_vector(spark, lake):
    records = {n: sample_records(spark, n) for n in SAMPLE_RECORDS}
    stages.run_all(spark, lake, records, "bucket", DAY, DAY)
    table = master(spark, lake)
    checks = stages.table_checks(table, table.union(table), points(spark, lake).limit(1))
    assert {r["check_name"] for r in checks.filter("not passed").collect()} == {
        "master_ids_unique", "vectors_complete",
    }


def test_a_refetch_writes_compressed_batches_and_no_rows(spark, lake):
    for _ in range(2):
        land(spark, lake, "arxiv")
        stages.refine_sources(spark, lake)
    files = glob.glob(f"{lake.raw_table_path('arxiv')}/**/*.parquet", recursive=True)
    assert files and all(name.endswith(".zstd.parquet") for name in files)
    assert spark.read.parquet(lake.raw_table_path("arxiv")).count() == 2


def moved(spark, monkeypatch):
    """The plans of the writes of texts to raw tables, as they come, and the files that materialize wrote."""
    plans, asides = [], []
    append, write = tables.append_by_date, landing.materialize
    monkeypatch.setattr(tables, "append_by_date", lambda df, path: (plans.append(plan_of(df)), append(df, path)))
    monkeypatch.setattr(landing, "materialize", lambda *a: asides.append(write(*a)) or asides[-1])
    return plans, asides


@pytest.mark.parametrize("incremental", [False, True])
def test_a_refetch_moves_no_texts(spark, lake, monkeypatch, incremental):
    plans, asides = moved(spark, monkeypatch)
    for later in range(3):
        for name in ("arxiv", "pubmed"):
            stages.land_records(spark, lake, {name: sample_records(spark, name)}, "bucket", DAY + dt.timedelta(later))
        report = {s.source: s for s in stages.refine_sources(spark, lake, incremental=incremental)}
    assert len(plans) == 2 and len(asides) == 6
    assert not any({*schema.CLEANED_FIELDS} & {*df.columns} for df in asides)
    # Not incrementally, all that ever landed is looked at again.
    read = 2 if incremental else 6
    assert (report["arxiv"].rows_read, report["arxiv"].rows_kept, report["arxiv"].rows_stored) == (read, read, 0)
    assert spark.read.parquet(lake.raw_table_path("arxiv")).count() == 2


@pytest.mark.parametrize("shipped", [0, 100])
@pytest.mark.parametrize("incremental", [False, True])
def test_new_records_among_fetched_ones_are_all_stored(spark, lake, monkeypatch, shipped, incremental):
    monkeypatch.setattr(tables, "SHIPPED_RECORDS", shipped)
    monkeypatch.setattr(tables, "HOT_COPIES", 3)
    monkeypatch.setattr(tables, "CELL_BYTES", 100)
    plans, _ = moved(spark, monkeypatch)
    base = sample_records(spark, "arxiv").crossJoin(spark.range(9).toDF("n"))
    named = base.withColumn("title", F.concat("title", F.lit(" "), F.col("n") % 4)).drop("n")
    # New on the second day are hot records of a date of their own, and records without a date.
    hot = named.withColumns({"title": F.lit("a title that is hot"), "publication_date": F.lit("2024-01-02")})
    undated = named.withColumn("publication_date", F.lit("unknown"))
    for later, batch in enumerate((named, named.unionByName(hot).unionByName(undated), hot.unionByName(undated))):
        stages.land_records(spark, lake, {"arxiv": batch}, "bucket", DAY + dt.timedelta(later))
        stages.refine_sources(spark, lake, incremental=incremental)
    stored = spark.read.schema(schema.raw_table_schema()).parquet(lake.raw_table_path("arxiv"))
    rows = stored.collect()
    assert len({(r["id"], r["record_hash"]) for r in rows}) == len(rows) == 8 + hot.distinct().count() + 8
    days = {(r["title"] == "a title that is hot", r["day"]): r["pdf_s3_path"].split("/")[-2] for r in rows}
    assert days == {(False, 15): "16", (False, 14): "16", (True, 2): "17", (False, None): "17"}
    assert len(plans) == 2 and plans[1].count("REPARTITION_BY_COL") == 1
