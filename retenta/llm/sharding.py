"""Sharding by proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked there. A row's fractional rank,
(rank - 1/2) / rows of the source, says how far into its source it stands; ordered by it, all
sources run out together. The order is cut into ``shards`` runs of equal count, so the law is
``rows``: counts differ by one at most, and each shard holds each source's share of rows to
within two rows. Slots count from 0 in the order of the fractional ranks.

Both ranks are global orders over range partitions (``operators.ordering``), so a source that
holds a third of all rows spreads over many of them. Rows equal in all that is looked at are
told apart by their place in a written table, which spreads them too. Texts are read once, for
their size and hash; only narrow rows are sorted.

``plan`` gives the places, ``sharded`` the documents themselves with shard and slot, and
``write_shards`` writes them, a folder a shard with its rows in the order of slots.

Edge cases: null texts have no bytes (size 16, crc 0); a null source is a source of its own,
ordered last, and the empty string is another; null doc_ids are shuffled by their text; repeated
rows each get a slot of their own; with fewer rows than shards some shards are empty; an empty
table gives an empty result; other columns, whatever their names, don't matter. Groups of equal
texts play no part in this law.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from retenta.llm.frames import column, partitions, unwrapped, whole_rows
from retenta.operators.ordering import row_number_global
from retenta.session import materialize

SHARDS = 40
SEED = 13
#: Bytes that a row counts beside its text.
EXTRA = 16


def _measured(docs: DataFrame, seed: int) -> DataFrame:
    """One narrow row a document, in a written table; ``seq`` is its place there."""
    text = F.coalesce(column(docs, "text"), F.lit("")).cast("binary")
    doc_id = column(docs, "doc_id").cast("long")
    return materialize(docs.select(
        doc_id.alias("doc_id"), column(docs, "source").alias("source"), (F.length(text) + EXTRA).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(F.lit(seed), doc_id, text).alias("mix"),
        F.monotonically_increasing_id().alias("seq")), "shard-sizes")


def _placed(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` (source, mix, seq, ..) with shard and slot."""
    ranked = row_number_global(rows, ["mix", "seq"], ["source"], name="rank", total_name="of")
    ranked = ranked.withColumn("share", (2 * F.col("rank") - 1) / (2 * F.col("of")).cast("double"))
    placed = row_number_global(ranked, ["share", "source", "rank"], name="place", total_name="total")
    shard = F.expr(f"((place - 1) * {shards}) div total")
    first = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return (placed.withColumn("shard", shard).withColumn("slot", F.col("place") - 1 - first)
            .withColumn("shard", F.col("shard").cast("int")).drop("share", "place", "total"))


def plan(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, source."""
    if shards < 1:
        raise ValueError("shards must be positive")
    return _placed(_measured(docs, seed), shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source")


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(row, shard, slot): every document whole, as a struct, with its place."""
    rows = docs.select(whole_rows(docs).alias("row"), column(docs, "source").alias("source"),
                       F.xxhash64(F.lit(seed), column(docs, "doc_id").cast("long"), F.coalesce(column(docs, "text"), F.lit("")).cast("binary")).alias("mix"),
                       F.monotonically_increasing_id().alias("seq"))
    rows = materialize(rows, "shard-rows")
    places = _placed(rows.select("source", "mix", "seq"), shards).select("seq", "shard", "slot")
    return rows.select("row", "seq").join(places, "seq").select("row", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Parquet under ``path``, a folder ``__shard=n`` a shard; files and their rows follow the slots."""
    rows = sharded(docs, shards, seed)
    n = max(shards, partitions(docs.sparkSession))
    rows = rows.repartitionByRange(n, "shard", "slot").sortWithinPartitions("shard", "slot")
    out = unwrapped(rows.select("row", "shard"), "row", docs).columns
    rows.select(*[F.col("row").getField(c).alias(c) for c in out], F.col("shard").alias("__shard")).write.mode(
        "overwrite").partitionBy("__shard").parquet(path)
