"""Small DataFrame helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

#: Bytes of text that a Python task handles at once.
SLAB = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(df: DataFrame, name: str) -> Column:
    """The column called exactly ``name``, whatever else the table holds."""
    return F.col(quoted(name))


def whole_rows(df: DataFrame) -> Column:
    """All columns as one struct, so helper columns beside it can't clash with any name."""
    return F.struct(*[F.col(quoted(c)).alias(c) for c in df.columns])


def unwrapped(df: DataFrame, row: str, like: DataFrame) -> DataFrame:
    """The columns of ``like`` back out of the struct column ``row``."""
    return df.select(*[F.col(row).getField(c).alias(c) for c in like.columns])


def row_variant(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Column:
    """Tells rows of one doc_id apart: 0 where doc_id decides the text (looked up in one
    small job), otherwise the text's hash. Identical repeated rows stay alike."""
    h = F.xxhash64(F.coalesce(column(df, text), F.lit("")))
    twice = (df.select(column(df, doc_id).alias("k"), h.alias("h")).groupBy("k")
             .agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi"))
    return h if twice.limit(1).count() else F.lit(0).cast("long")


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | StructType) -> DataFrame:
    return df.mapInArrow(fn, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """Each text's UTF-8 bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slabs(batches: Iterator[pa.RecordBatch], text: str = "text",
          limit: int = SLAB) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Row slices whose texts together hold about ``limit`` bytes (one row at least)."""
    for batch in batches:
        texts, start, held = utf8(batch.column(text)), 0, 0
        for i, x in enumerate(texts):
            held += len(x)
            if held >= limit or i == len(texts) - 1:
                yield batch.slice(start, i + 1 - start), texts[start:i + 1]
                start, held = i + 1, 0


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
