"""Intermediate tables in the shared folder, and small helpers of the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalbook.session import new_dir

#: Words of a text are the runs between these characters.
SPACES = r"[\x20\x09-\x0D]+"
#: The columns of ``documents``.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the folder all executors share, and read
    back: its lineage ends there, and a lost executor costs no recomputation."""
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile gives up its shuffle files when it is done, and
    not when the driver next collects garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder in the shared folder whose rows are no longer read."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def words_of(text: Column) -> Column:
    """The words of a text; none where it is null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def with_value(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` and
    the functions in it use it, and wherever the optimizer moves the whole."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def document_columns(docs: DataFrame) -> DataFrame:
    """Only the columns of ``documents``, with their types; missing ones null."""
    kinds = dict(zip(DOCUMENT, ("bigint", "string", "string", "string", "bigint"), strict=True))
    return docs.select(
        *[(F.col(c) if c in docs.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in DOCUMENT]
    )


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a slice hold about ``size`` bytes;
    a longer text is a slice of its own."""
    for batch in batches:
        text = batch.column(column).cast(pa.large_binary())
        lengths = np.diff(np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1])
        begin, held = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if i > begin and held + n > size:
                yield batch.slice(begin, i - begin)
                begin, held = i, 0
            held += n
        if begin < batch.num_rows:
            yield batch.slice(begin)
