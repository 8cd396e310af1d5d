"""Landing folders as streams: each landed file is taken in once, ever.

The list of files already read is kept in a stream checkpoint, so a run costs only
what is new. A run takes any number of new files in batches of bounded size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paperlake.operators.refine import refine, to_records
from paperlake.plans.tables import append_outlined_records, outline
from paperlake.session import materialize
from paperlake.settings import CODEC, LakeSettings, Source
from paperlake.sources.records import MALFORMED, file_names, read_files, to_papers


@dataclass
class Ingested:
    """Records read, those of them that were no records at all, and those kept by the rules."""

    read: int = 0
    malformed: int = 0
    kept: int = 0

    def add(self, other: Ingested) -> None:
        self.read += other.read
        self.malformed += other.malformed
        self.kept += other.kept


def landing_stream(spark: SparkSession, settings: LakeSettings, source: Source) -> DataFrame:
    """The names of landed files, a bounded number in each batch; their content is not read here."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", file_names(source.format))
        .option("maxFilesPerTrigger", settings.max_files_per_batch)
        .load(settings.landing_path(source.name))
        .select("path", "length")
    )


def append_refined(
    spark: SparkSession, settings: LakeSettings, source: Source, raw: DataFrame, stamp: Column | None, prune: bool
) -> Ingested:
    """Refine raw records and append the new ones to the source's raw table.

    A first job reads the records, observes the counts and writes the batch's outline aside:
    no texts. The landed files are read once more for what is new, not at all if nothing
    is; a copy of the texts aside would be written and read as well.
    """
    malformed = F.col(MALFORMED) if MALFORMED in raw.columns else F.lit(False)
    taken, passed = Observation(), Observation()
    papers = to_papers(raw.withColumn(MALFORMED, malformed), source.name, keep=[MALFORMED])
    papers = papers.observe(taken, F.count(F.lit(1)).alias("read"), F.count_if(MALFORMED).alias("malformed"))
    kept = refine(papers.drop(MALFORMED), settings).observe(passed, F.count(F.lit(1)).alias("kept"))
    outlined = materialize(outline(to_records(kept, stamp)), f"batch-{source.name}", CODEC)
    records = to_records(refine(to_papers(raw, source.name), settings), stamp)
    append_outlined_records(spark, records, outlined, settings.raw_table_path(source.name), prune)
    return Ingested(**taken.get, **passed.get)


def ingest_new_files(
    spark: SparkSession,
    settings: LakeSettings,
    source: Source,
    checkpoint: str,
    stamp: Column | None = None,
) -> Ingested:
    """Refine the files landed since the last call and append them to the raw table.

    Returns when all of them are in. Each batch's file names are written below
    ``settings.landed_files_path`` first. A batch that is retried after a failure finds
    its records already stored and appends nothing.
    """
    total = Ingested()

    def append(batch: DataFrame, batch_id: int) -> None:
        listed = f"{settings.landed_files_path(source.name)}/batch={batch_id}"
        batch.coalesce(1).write.mode("overwrite").parquet(listed)
        own = batch.sparkSession
        # At most max_files_per_batch names.
        paths = [r["path"] for r in own.read.schema("path string").parquet(listed).collect()]
        if paths:
            files = read_files(own, paths, source.format)
            total.add(append_refined(own, settings, source, files, stamp, prune=True))

    query = (
        landing_stream(spark, settings, source)
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return total
