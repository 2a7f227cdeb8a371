"""Shared pieces of the corpus operators: scratch tables, row batches, words."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_folder

TEXT_CHARS = 200_000  # characters worked on at once inside a task


class Scratch:
    """Tables written to the shared checkpoint folder, which can be dropped one by one."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
        self.made = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """``df`` written and read back: later jobs start from the files, whatever executors are lost."""
        self.made += 1
        path = f"{self.root}/{self.made}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch_path = path
        return back

    def drop(self, df: DataFrame) -> None:
        """Remove the files of a table that nothing reads any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df._scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_crc(key: str = "doc_id") -> Column:
    """CRC-32 of the id written as text; null for a null id."""
    return F.crc32(F.col(key).cast("string").cast("binary"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names`` made different from every column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def text_groups(texts: list[str], limit: int = TEXT_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``limit`` characters together; a longer text stands alone."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)
