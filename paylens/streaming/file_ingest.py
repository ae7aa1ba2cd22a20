"""New-files-only ingest as Structured Streaming.

A file-source stream over the landing folder, run with
``trigger(availableNow=True)``: every run processes exactly the files not
yet seen (tracked in the checkpoint), writes them through the same
transformation as the batch job, and stops.  The checkpoint and output
live in shared storage, so a lost executor or a restarted run resumes
without duplicates.  A file replaced under the same name is not re-read
by a file stream; use the manifest diff (R4) for that case.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def ingest_new_files(spark: SparkSession, landing: str, schema: T.StructType, out: str,
                     checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                     fmt: str = "csv", options: dict | None = None,
                     partition_by=(), max_files_per_trigger: int | None = None) -> None:
    """Process every not-yet-seen file of ``landing`` into Parquet at ``out``."""
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing)
    if transform is not None:
        stream = transform(stream)
    writer = (stream.writeStream.format("parquet").option("path", out)
              .option("checkpointLocation", checkpoint).option("compression", "zstd")
              .outputMode("append").trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def ingest_new_drops(spark: SparkSession, landing: str, header: list[str], out: str,
                     checkpoint: str, sep: str = ";", encoding: str = "ISO-8859-1",
                     partition_by=("origen", "anyo", "Mes", "drop")) -> None:
    """New bulk CSV drops -> unified, partitioned pay Parquet (S13 + C12).

    Every drop must have ``header`` (probe one file with
    ``readers.read_header``): Spark checks each file's own header line against
    it and fails the run on a file whose columns are named or ordered
    otherwise, rather than mapping them by position.  Columns are read as
    text, unified with the
    candidate lists, cleaned, folded and tagged with the source found in
    each file's own name.  Files already processed are skipped through the
    checkpoint, so re-running after a failure or with new drops writes each
    row once.
    """
    from pyspark.sql import functions as F

    from paylens.operators.unify import origin_from_name, pay_rows

    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])

    def transform(raw: DataFrame) -> DataFrame:
        # by position from here on: names may differ in case only
        raw = raw.withColumn("drop", F.col("_metadata.file_name")).toDF(*[f"_c{i}" for i in range(len(header))], "drop")
        return pay_rows(raw, origin_from_name(F.col("drop")), header=[*header, "drop"], keep=("drop",))

    ingest_new_files(spark, landing, schema, out, checkpoint, transform=transform, fmt="csv",
                     options={"sep": sep, "encoding": encoding, "header": "true",
                              "enforceSchema": "false", "mode": "PERMISSIVE"},
                     partition_by=partition_by)


def ingest_mixed_drops(spark: SparkSession, landing: str, out: str, checkpoint: str, pattern: str = "*.csv",
                       max_files_per_trigger: int | None = None, skipped: list | None = None) -> None:
    """New bulk CSV drops, each with a header of its own -> committed pay table (S13 + C12).

    The stream carries the names of new files only.  Each micro-batch is one
    batch ingest of its drops: grouped by header, one scan per header, and
    committed as one generation.  A drop is known by its path below
    ``landing`` and replaces itself, so a batch that runs again after a lost
    driver writes every row once.  Parts of one drop (a folder) belong
    together: land them before the run.  ``skipped`` collects (path, reason); a
    file of no bytes is passed over.
    Read the table with :func:`paylens.sources.generations.read`.
    """
    import re

    from paylens.operators.legislative import ingest_bulk_csv

    files = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
             .option("recursiveFileLookup", True).option("pathGlobFilter", pattern))
    if max_files_per_trigger:
        files = files.option("maxFilesPerTrigger", max_files_per_trigger)

    def batch(names: DataFrame, batch_id: int) -> None:
        # a name per drop: what a scan of them needs, too
        drops = sorted({re.sub(r"/part-[^/]*$", "", r["path"]) for r in names.select("path").collect()})
        if drops:
            ingest_bulk_csv(names.sparkSession, drops, out, skipped=skipped, root=landing)

    query = (files.load(landing).select("path").writeStream.foreachBatch(batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
