"""Mixing sources to target weights.

Tokens are summed per source, targets are filled up like water under a cap, and a
document of a source with repetition rate r is emitted floor(r) times plus one
Bernoulli copy of probability r - floor(r), drawn from a seeded hash of the document.

Sources number far fewer than documents, but no table of them is collected: the water
level is found by a loop in which the driver sees three sums a round. The level only
rises and each round caps at least one more source, so the loop ends; in practice after
a few rounds. The rates are a written table, so Spark broadcasts it by its known size or
else joins it with skew splitting.

Edge cases: null texts have size 0; a null source is a source of its own, ordered last;
the empty string is another. A source of size 0 has target and rate 0. Rows repeated in
the input are drawn alike. A null doc_id is drawn by its text. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from retenta.llm.frames import column, unwrapped, whole_rows
from retenta.operators.ordering import row_number_global
from retenta.session import materialize

#: Fixed values of the mix: weights by source order, repeating, and the most repetitions.
WEIGHTS = (1, 2, 3)
MOST = 3
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) fixed by the seed and the document: 52 bits of an MD5."""
    key = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "|"), key)), 1, 13), 16, 10)
    return bits.cast("double") / F.lit(float(1 << 52))


def source_rates(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, size) rows to one row a source: source_size, target, rate."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    src = row_number_global(src, [F.col("source").asc_nulls_last()], name="place")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    src = materialize(src.select("source", "source_size", weight.alias("weight")), "mix-sources")
    cap = F.col("source_size") * most
    total = src.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, None
    while True:
        over = F.col("weight") * F.lit(level) > cap
        n, held, free = src.agg(F.count_if(over), F.sum(F.when(over, cap).otherwise(0)),
                                F.sum(F.when(over, 0).otherwise(F.col("weight")))).first()
        if n == capped or not free:
            break
        capped, level = n, (total - held) / free
    target = F.when(F.col("weight") * F.lit(level) > cap, cap.cast("double")).otherwise(F.col("weight") * F.lit(level))
    return src.withColumn("target", target).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))


def copies(rate: Column, chance: Column) -> Column:
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and draw of every row, written once: the text is read a single time."""
    text = column(docs, "text")
    return materialize(docs.select(
        column(docs, "doc_id").alias("doc_id"), column(docs, "source").alias("source"),
        words_in(text).alias("size"), draw(column(docs, "doc_id"), text).alias("chance")), "mix-sizes")


def taken_words(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken, copies."""
    sizes = measured(docs)
    rates = materialize(source_rates(sizes), "mix-rates").withColumnRenamed("source", "of")
    out = sizes.join(rates, F.col("source").eqNullSafe(F.col("of")))
    n = copies(F.col("rate"), F.col("chance"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * n).alias("taken"),
                      n.alias("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with its own columns."""
    text = column(docs, "text")
    sizes = docs.select(column(docs, "source").alias("source"), words_in(text).alias("size"))
    rates = materialize(source_rates(sizes), "mix-rates").select(F.col("source").alias("of"), "rate")
    rows = docs.select(whole_rows(docs).alias("row"), column(docs, "source").alias("source"),
                       draw(column(docs, "doc_id"), text).alias("chance"))
    out = rows.join(rates, F.col("source").eqNullSafe(F.col("of")))
    out = out.select("row", F.explode(F.array_repeat(F.lit(0), copies(F.col("rate"), F.col("chance")).cast("int"))))
    return unwrapped(out, "row", docs)


#: Rows for ``taken_words``; the water level in closed form: sources by ascending cap per weight.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, md5(coalesce(text, '')))), 1, 13))::BIGINT::DOUBLE
      / 4503599627370496.0::DOUBLE AS chance
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight FROM s0),
s2 AS (SELECT *, coalesce(sum(3 * source_size) OVER w, 0)::BIGINT AS before, coalesce(sum(weight) OVER w, 0)::BIGINT AS gone,
    sum(source_size) OVER ()::BIGINT AS total, sum(weight) OVER ()::BIGINT AS weights
  FROM s1 WINDOW w AS (ORDER BY 3 * source_size / weight::DOUBLE, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lvl AS (SELECT arg_min((total - before) / (weights - gone)::DOUBLE, 3 * source_size / weight::DOUBLE) AS level FROM s2
  WHERE weight * ((total - before) / (weights - gone)::DOUBLE) <= 3 * source_size),
s3 AS (SELECT source, source_size, CASE WHEN weight * level > 3 * source_size THEN (3 * source_size)::DOUBLE
    ELSE weight * level END AS target FROM s2, lvl),
s4 AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate FROM s3),
r AS (SELECT d.doc_id, d.size, s4.source_size, s4.target,
    (floor(s4.rate) + CASE WHEN d.chance < s4.rate - floor(s4.rate) THEN 1 ELSE 0 END)::BIGINT AS copies
  FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM r
"""
