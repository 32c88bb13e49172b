"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from markerlens.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str = "part") -> DataFrame:
    """Write a table to the folder of ``spark.checkpoint.dir`` and read it back: lineage is cut and
    the rows survive a lost executor. Columnar, so later reads take only the columns they need."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stored(*frames: DataFrame) -> None:
    """Delete tables written by ``stored`` that no later step reads."""
    for df in frames:
        jvm = df.sparkSession._jvm
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def text_rows(df: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text (null: empty) and text_key; (doc_id, text_key) names a row or its exact repeats.

    Other columns, whatever their names, are left out, so nothing can clash.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), t.alias("text"),
                     F.xxhash64(t).alias("text_key"))


def is_held_out(column: str, folds: int) -> F.Column:
    """Whether crc32(doc_id as text) mod ``folds`` is 0. A null id counts as held out."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % folds == 0, F.lit(True))
