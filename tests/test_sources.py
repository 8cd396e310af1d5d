from __future__ import annotations

import datetime as dt
import glob
import os

import pandas as pd
import pytest

from paperlake import schema
from paperlake.settings import LakeSettings, Source
from paperlake.sources import records
from paperlake.sources.samples import SAMPLE_RECORDS, sample_records

DAY = dt.date(2024, 1, 20)


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_round_trip_descends_into_dated_folders(spark, folder, fmt):
    prepared = records.prepare_records(sample_records(spark, "arxiv"), "b", DAY)
    records.write_records(prepared, folder, DAY, fmt)
    assert os.path.isdir(f"{folder}/2024/01/20")
    rows = records.to_papers(records.read_records(spark, folder, fmt)).orderBy("publication_date").collect()
    assert [r["publication_date"] for r in rows] == [dt.date(2024, 1, 14), dt.date(2024, 1, 15)]
    assert rows[1]["id"] == "8b32bcfd950783d9d369cd07b10217e14e9b2d37f21566557307ecaaff5351cf"
    assert rows[1]["pdf_s3_path"] == f"s3://b/raw_pdfs/arxiv/2024/01/20/{rows[1]['id']}.pdf"
    assert all(r["doi"] is None and r["full_text"] is None for r in rows)
    assert all(r["ingestion_timestamp"] is not None for r in rows)


def test_unsupported_format_is_an_error(spark, folder):
    with pytest.raises(ValueError, match="Unsupported file format: csv"):
        records.read_records(spark, folder, "csv")
    with pytest.raises(ValueError):
        records.write_records(sample_records(spark, "arxiv"), folder, DAY, "csv")


def test_null_columns_keep_their_type(spark, folder):
    records.write_records(sample_records(spark, "arxiv"), folder, DAY)
    inferred = spark.read.option("recursiveFileLookup", True).parquet(folder).schema
    assert inferred["doi"].dataType.typeName() == "string"


def test_missing_columns_read_as_null(spark, folder):
    spark.createDataFrame([("t",)], "title string").write.mode("append").parquet(folder)
    (row,) = records.read_records(spark, folder).collect()
    assert row["title"] == "t" and row["doi"] is None


def test_files_of_other_writers_load_with_the_same_ids(spark, folder):
    records.write_records(records.prepare_records(sample_records(spark, "arxiv"), "b", DAY), folder, DAY)
    frame = pd.DataFrame(SAMPLE_RECORDS["arxiv"])  # doi is None in every row
    frame.to_parquet(f"{folder}/pandas.parquet")
    typed = frame.assign(publication_date=[dt.date(2024, 1, 15), dt.date(2024, 1, 14)], doi="10.1000/x")
    typed["ingestion_timestamp"] = pd.Timestamp("2024-01-16 01:02:03")
    typed.to_parquet(f"{folder}/typed.parquet", coerce_timestamps="us")
    rows = records.to_papers(records.read_records(spark, folder)).collect()
    assert len(rows) == 6 and len({r["id"] for r in rows}) == 2
    assert {r["publication_date"] for r in rows} == {dt.date(2024, 1, 15), dt.date(2024, 1, 14)}
    assert {r["doi"] for r in rows} == {None, "10.1000/x"}
    assert dt.datetime(2024, 1, 16, 1, 2, 3) in {r["ingestion_timestamp"] for r in rows}


def test_footers_are_read_without_the_files_content(spark, folder):
    """Files of three schemas, each larger than what a binary file row may hold."""
    records.write_records(records.prepare_records(sample_records(spark, "arxiv"), "b", DAY), folder, DAY)
    frame = pd.DataFrame(SAMPLE_RECORDS["arxiv"])
    frame.to_parquet(f"{folder}/a b.parquet")
    frame.assign(publication_date=[dt.date(2024, 1, 15), dt.date(2024, 1, 14)]).to_parquet(f"{folder}/typed.parquet")
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "1000")
    try:
        assert records.to_papers(records.read_records(spark, folder)).count() == 6
    finally:
        spark.conf.unset(limit)


def test_an_empty_folder_has_no_records(spark, folder):
    assert records.read_records(spark, folder).isEmpty()


def test_unparsable_dates_become_null_and_ids_come_from_the_text(spark):
    raw = records.conform(spark.createDataFrame(
        [("Title", "A", "no date"), ("Title", "A", "2024-1-5"), ("Title", "A", "2024-01-05")],
        "title string, authors string, publication_date string",
    ))
    rows = records.to_papers(raw, "ieee").collect()
    assert [r["publication_date"] for r in rows] == [None, dt.date(2024, 1, 5), dt.date(2024, 1, 5)]
    assert len({r["id"] for r in rows}) == 3
    assert {r["source"] for r in rows} == {"ieee"}


def test_malformed_json_reads_as_nulls(spark, folder):
    with open(f"{folder}/a.json", "w") as f:
        f.write('{"title": "ok", "publication_date": "2024-01-05"}\n{broken\n')
    rows = records.read_records(spark, folder, "json").collect()
    assert sorted(str(r["title"]) for r in rows) == ["None", "ok"]


def test_mapping_renames_keeps_and_fills(spark):
    df = spark.createDataFrame(
        [("t", "x", "u", "wrong", "old")], "name string, extra string, pdf_url string, source string, title string"
    )
    mapped = records.map_fields(df, {"name": "title", "absent": "doi"}, "acm")
    assert mapped.columns == schema.raw_schema().names
    (row,) = mapped.collect()
    assert (row["title"], row["source"], row["pdf_url"], row["authors"], row["doi"]) == ("t", "acm", "u", None, None)


def test_union_keeps_every_row_and_fills_columns(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "i int, c string")
    b = spark.createDataFrame([(2,)], "i int")
    rows = records.union_papers([a, b]).orderBy("i").collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (1, "x"), (2, None)]


def test_registry_and_environment(monkeypatch):
    lake = LakeSettings("/lake")
    assert [s.name for s in lake.enabled_sources] == ["arxiv", "pubmed", "ieee", "acm"]
    assert lake.source("acm") == Source("acm", "json", True, 4)
    with pytest.raises(KeyError):
        lake.source("unknown")
    monkeypatch.setenv("PARTITION_LOOKBACK_DAYS", "30")
    assert LakeSettings.from_env("/lake").lookback_days == 30


def test_sample_records_count(spark):
    assert {name: sample_records(spark, name).count() for name in SAMPLE_RECORDS} == {"arxiv": 2, "pubmed": 1}


def test_landed_lines_are_compressed_and_plain_ones_are_read(spark, folder):
    df = spark.createDataFrame([{"title": "long enough title", "source": "acm"}])
    records.write_records(df, folder, dt.date(2024, 1, 2), "json")
    with open(f"{folder}/a.json", "w") as f:
        f.write('{"title": "plain"}\n')
    names = glob.glob(f"{folder}/2024/01/02/*.json*")
    assert names and all(name.endswith(".json.gz") for name in names)
    assert {r["title"] for r in records.read_records(spark, folder, "json").collect()} == {"long enough title", "plain"}
