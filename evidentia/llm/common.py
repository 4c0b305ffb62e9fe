"""Helpers shared by the operators: durable tables, fixed-size hashes, white space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Fixed value: the characters that separate words, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share: the one of spark.checkpoint.dir.

    Only a local master without that setting (tests) gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.sparkContext.master.startswith("local"):
        configured = tempfile.mkdtemp(prefix="evidentia-llm-")
        spark.conf.set("spark.checkpoint.dir", configured)
        return configured
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder as Parquet and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that :func:`stored` wrote and nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if "/llm-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def columns(df: DataFrame, *without: str) -> list[Column]:
    """All columns of a frame but some, also those whose names hold dots or back quotes."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c not in without]


def fingerprint(value: Column, digits: int = 13) -> Column:
    """The leading ``digits`` hexadecimal digits of the MD5 of a string, as a long."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, digits), 16, 10).cast("long")


def words(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text in order; null text has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    return F.array_remove(F.split(spaced, " "), "")
