"""Incremental corpus ingest (SRC-3, SRC-4, JN-6, §2.13) as Structured Streaming.

CSV files landing in ``src_dir`` are found by a file-source stream; its checkpoint records
which files are done (the progress log of the reference), so a rerun picks up only new files
and a crash between read and write repeats the batch instead of losing it. The stream carries file names only;
each micro-batch reads its files with their own header row and width (SRC-2), notes the files it can't use in a table of
failed files (empty ones the file source passes over), cleans the rows (FLT-1…4), keeps the first of each clean key within the batch, and drops those that an earlier
batch has written.

What has been written is known by a table of SHA-256 digests of the clean keys, partitioned by their first hex digits: a batch reads
the partitions of its own digests only, never the texts. Rows and digests are written per batch and replaced when
the batch is repeated, and a batch does not see its own digests, so a repeat gives the same result. There is no event time, so no watermark.

Output that is there without the progress of a checkpoint is not added to: that would write every file's rows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from markerlens.functions import text as T
from markerlens.sources import readers as R

#: Hex digits of a digest that name its partition.
DIGEST_DIGITS = 2


def _holds_files(spark: SparkSession, folder: str) -> bool:
    """Whether a folder is there and holds anything but hidden files (a failing listing stays an error)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(path) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(path))


def clean_batch(batch: DataFrame, max_chars: int = 560, labels: Sequence[int] = (0, 1),
                exclude_terms: Sequence[str] = ("reuters",)) -> DataFrame:
    """Filters of the cleaning step and keep-first per clean key (by its digest) inside the batch."""
    cond = F.col("label").isin(*labels) & ~T.is_blank("text") & (F.length("text") <= max_chars)
    for t in exclude_terms:
        cond = cond & ~F.lower("text").contains(t)
    b = batch.where(cond).withColumn("clean_key", T.clean_key("text")).withColumn("digest", F.sha2("clean_key", 256))
    w = Window.partitionBy("digest").orderBy("source_file", "source_row")
    return (b.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
            .withColumn("prefix", F.left("digest", F.lit(DIGEST_DIGITS))))


def seen_digests(spark: SparkSession, keys_dir: str, prefixes: Sequence[str], batch_id: int) -> DataFrame | None:
    """Digests of other batches in the partitions ``prefixes``; None if there are none yet."""
    if not prefixes or not _holds_files(spark, keys_dir):
        return None
    keys = spark.read.schema("digest string, prefix string, batch_id long").parquet(keys_dir)
    return keys.where(F.col("prefix").isin(*prefixes) & (F.col("batch_id") != batch_id)).select("prefix", "digest")


def write_batch(spark: SparkSession, files: Sequence[str], batch_id: int, out_dir: str, keys_dir: str, failed_dir: str, **clean_kw) -> None:
    """Read, clean and append the rows of ``files``; note the files that can't be used."""
    told = R.csv_files(spark, files)
    (told.where("NOT ok").select("source_file", "reason").write.mode("overwrite").parquet(f"{failed_dir}/batch_id={batch_id}"))
    rows = R.read_csv_detect_header(spark, files).withColumn("label", F.col("label").try_cast("int"))
    cleaned = clean_batch(rows, **clean_kw)
    # at most 16 ** DIGEST_DIGITS names
    prefixes = [r[0] for r in cleaned.select("prefix").distinct().collect()]
    seen = seen_digests(spark, keys_dir, prefixes, batch_id)
    fresh = cleaned if seen is None else cleaned.join(seen, ["prefix", "digest"], "left_anti")
    own = f"{out_dir}/batch_id={batch_id}"
    fresh.select("text", "label", "clean_key", "source_file", "digest").write.mode("overwrite").parquet(own)
    (spark.read.schema("digest string").parquet(own)
     .select("digest", F.left("digest", F.lit(DIGEST_DIGITS)).alias("prefix"), F.lit(batch_id).alias("batch_id"))
     .repartition("prefix").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("prefix", "batch_id").parquet(keys_dir))


def run(spark: SparkSession, src_dir: str, out_dir: str, checkpoint: str, max_files_per_trigger: int | None = None,
        keys_dir: str | None = None, failed_dir: str | None = None, **clean_kw) -> int:
    """Process every file not yet seen, then stop (``availableNow``). Returns batches run.

    ``keys_dir`` and ``failed_dir`` default to folders beside ``out_dir``. FileExistsError: ``out_dir`` holds rows, but
    ``checkpoint`` no progress to go on from."""
    keys_dir, failed_dir = keys_dir or f"{out_dir.rstrip('/')}_keys", failed_dir or f"{out_dir.rstrip('/')}_failed"
    if _holds_files(spark, out_dir) and not _holds_files(spark, f"{checkpoint}/offsets"):
        raise FileExistsError(f"{out_dir} holds rows, and {checkpoint} no interrupted progress to resume: "
                              "give the checkpoint that wrote them, or remove the output to build it anew")
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    counter = {"batches": 0}

    def each(batch: DataFrame, batch_id: int) -> None:
        # the names that the file source lists itself; contents are not read here
        files = [r[0] for r in batch.collect()]
        if files:
            write_batch(batch.sparkSession, files, batch_id, out_dir, keys_dir, failed_dir, **clean_kw)
        counter["batches"] += 1

    q = (reader.load(src_dir).select("path").writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return counter["batches"]
