"""Mixing sources by a time-varying curriculum.

Every source has a schedule: its weight at some moments of the training time 0 to 1, linear between
them. The integral of a schedule is the source's weight for the whole training, and sets its target: a
share of all words, but no more than ``most`` times its own; what is over is shared again by weight. The
demand of a source by time t is its target times the part of its integral that lies before t. Its
documents (each ``most`` times at most, in an order of hashes) meet that demand one after another, so a
document's position is the time at which demand reaches the words before it: the inverted integral.
Documents of all sources are then range-sorted by position.

Only DataFrame operations. Sums inside a source are taken in two steps, by source and hash range and
then over the ranges, so that a source of a third of all rows has no task of its own.

Defined results: a null or empty text has size 0 and takes no words; a null source is a source (last in
order); sources without words have target 0; an empty table gives no rows. Repeated ids with equal texts
are taken as separate rows. Other columns pass through ``schedule`` as they are; columns with the names
that it adds are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from natalis.llm.base import cut, table

WORD = r"[^\x20\x09-\x0D]+"
Knots = list[tuple[float, float]]
#: Hash ranges of a source: the first three hex digits of the order.
RANGES = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def repeating(*weights: float) -> Callable[[Column], Column]:
    """Constant schedules whose weights repeat with the rank of the source."""

    def schedule(rank: Column) -> Column:
        weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
        return F.array(*[F.struct(F.lit(t).alias("t"), weight.alias("w")) for t in (0.0, 1.0)])

    return schedule


def turning(*weights: float) -> Callable[[Column], Column]:
    """Schedules whose mean weights repeat with the rank of the source: by turns they rise from half of it to half as much again, and fall."""

    def schedule(rank: Column) -> Column:
        weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
        first = F.when(rank % 2 == 0, weight * 0.5).otherwise(weight * 1.5)
        return F.array(*[F.struct(F.lit(t).alias("t"), w.alias("w")) for t, w in ((0.0, first), (1.0, 2 * weight - first))])

    return schedule


def listed(schedules: dict[str | None, Knots], other: Knots, source: str = "source") -> Callable[[Column], Column]:
    """Schedules given by source name."""

    def knots(points: Knots) -> Column:
        return F.array(*[F.struct(F.lit(float(t)).alias("t"), F.lit(float(w)).alias("w")) for t, w in points])

    def schedule(_: Column) -> Column:
        out = knots(other)
        for name, points in schedules.items():
            out = F.when(F.col(source).eqNullSafe(F.lit(name)), knots(points)).otherwise(out)
        return out

    return schedule


def targets(sizes: DataFrame, schedule: Callable[[Column], Column], most: int = 3) -> DataFrame:
    """One row for each source: source, source_size, weight, target and the pieces of its integral.

    ``sizes`` has (source, source_size). The level at which targets settle is found at once: sources in
    the order in which they reach their limit, and the first level that doesn't exceed the next source's
    limit (levels fall after it, so it is the largest such).
    The windows here go over one row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("knots", schedule(F.col("rank")))
    steps = F.expr("""transform(sequence(1, size(knots) - 1), i -> struct(
        knots[i - 1].t as t, knots[i].t - knots[i - 1].t as span, knots[i - 1].w as w, knots[i].w - knots[i - 1].w as rise,
        (knots[i - 1].w + knots[i].w) / 2 * (knots[i].t - knots[i - 1].t) as area))""")
    ranked = ranked.withColumn("pieces", steps).withColumn("weight", F.expr("aggregate(pieces, 0D, (s, p) -> s + p.area)"))
    ranked = ranked.withColumn("limit", F.when(F.col("weight") > 0, F.lit(most) * F.col("source_size")).otherwise(F.lit(0)))
    reach = F.when(F.col("weight") > 0, F.col("limit") / F.col("weight")).otherwise(F.lit(0.0))
    order = Window.orderBy(reach, "rank")
    everything = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = ranked.withColumn("reach", reach)
    ranked = ranked.withColumn("level", F.try_divide(F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)), F.sum("weight").over(after)))
    ranked = ranked.withColumn("level", F.max(F.when((F.col("level") <= F.col("reach")) & (F.col("weight") > 0), F.col("level"))).over(everything))
    target = F.when(F.col("level").isNull(), F.col("limit").cast("double")).otherwise(F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight")))
    return ranked.select("source", "source_size", "weight", "pieces", target.alias("target"))


def position(demand: Column, target: Column, weight: Column, pieces: Column) -> Column:
    """The time at which a source's demand reaches so many words: its integral inverted."""
    area = (demand * weight / target).alias("area")
    found = F.aggregate(
        pieces,
        F.struct(area, F.lit(None).cast("double").alias("at")),
        lambda s, p: F.struct(
            (s["area"] - p["area"]).alias("area"),
            F.when(s["at"].isNotNull() | (s["area"] >= p["area"]), s["at"]).otherwise(
                p["t"]
                + p["span"]
                * F.when(p["rise"] == 0, F.when(p["area"] == 0, F.lit(0.0)).otherwise(s["area"] / p["area"])).otherwise(
                    # the root of rise / 2 * x^2 + w * x = area / span that lies in the piece
                    F.coalesce(F.try_divide(2 * s["area"] / p["span"], p["w"] + F.sqrt(F.greatest(F.lit(0.0), p["w"] * p["w"] + 2 * p["rise"] * s["area"] / p["span"]))), F.lit(0.0))
                )
            ).alias("at"),
        ),
        lambda s: s["at"],
    )
    return F.when(target > 0, F.least(F.lit(1.0), F.coalesce(found, F.lit(1.0))))


def plan(docs: DataFrame, schedule: Callable[[Column], Column], most: int = 3, id_: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row for each row of docs: id, ``twin`` (a hash of its text), source, size, source_size, target, ``whole`` (times it is taken whole),
    ``cut`` (words taken once more, of the document that ends its source's last turn, or all of it), ``taken``, and
    the positions of the turns.
    """
    key = F.md5(F.coalesce(F.col(id_).cast("string"), F.lit("")).cast("binary"))
    rows = cut(docs.select(F.col(id_).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("twin"), key.alias("key")))
    rows = rows.withColumn("range", F.substring("key", 1, RANGES))
    ranges = cut(rows.groupBy("source", "range").agg(F.sum("size").alias("words")))
    sources = targets(ranges.groupBy("source").agg(F.sum("words").alias("source_size")), schedule, most)
    starts = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("source", "range", F.coalesce(F.sum("words").over(starts), F.lit(0)).alias("start"))
    marks = starts.alias("a").join(sources.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("a.*", "b.source_size", "b.weight", "b.target", "b.pieces")
    inside = Window.partitionBy("source", "range").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.alias("a").join(marks.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.range") == F.col("b.range")))
    rows = rows.select("a.id", "a.twin", "a.source", "a.size", (F.col("a.inner") + F.col("b.start")).alias("before"), "b.source_size", "b.weight", "b.target", "b.pieces")
    goal = F.round("target").cast("long")
    turns = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as long) div source_size")).otherwise(0).cast("long")
    rows = rows.withColumn("whole", turns)
    rest = goal - F.col("whole") * F.col("source_size") - F.col("before")
    rows = rows.withColumn("cut", F.greatest(F.lit(0), F.least(F.col("size"), rest)).cast("long"))
    times = F.expr("whole + if(cut > 0, 1, 0)").cast("int")
    at = F.when((F.col("size") > 0) & (times > 0), F.transform(F.sequence(F.lit(0), times - 1), lambda k: position(F.col("before") + k * F.col("source_size"), F.col("target"), F.col("weight"), F.col("pieces"))))
    return rows.select("id", "twin", "source", "size", "source_size", "target", "whole", "cut", (F.col("whole") * F.col("size") + F.col("cut")).alias("taken"), F.coalesce(at, F.array().cast("array<double>")).alias("positions"))


def ordered(docs: DataFrame, planned: DataFrame, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """The training order: a row for each turn of each taken document, range-sorted by ``position``.

    ``turn`` counts from 0; ``words`` are those to read from its start: all but for the document at which a
    source's demand ends. Rows of docs are told apart by id and text; of those that agree in both, docs has
    one here, and each turn planned for any of them is a row.
    """
    turns = planned.where("taken > 0").select(F.col("id").alias("_id"), F.col("twin").alias("_twin"), "size", "whole", "cut", F.posexplode("positions").alias("turn", "position"))
    turns = turns.select("_id", "_twin", "turn", "position", F.when(F.col("turn") < F.col("whole"), F.col("size")).otherwise(F.col("cut")).alias("words"))
    rows = docs.drop("turn", "position", "words")
    rows = rows.join(turns, F.col(id_).eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_twin"))).drop("_id", "_twin")
    return rows.orderBy("position", F.md5(F.col(id_).cast("string").cast("binary")), "turn")


def op8_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed with weights 5, 2, 1 over the sources in order, to 3 times a source's words at most, sorted by position.

    The weights are the means over the training time: sources by turns come more and more often, or less and less.
    """
    planned = plan(table(spark, sf_dir, "documents"), turning(5, 2, 1))
    rows = planned.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", F.get("positions", F.lit(0)).alias("position"))
    return rows.orderBy(F.col("position").asc_nulls_last(), F.xxhash64("doc_id"))


OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3]::DOUBLE AS weight,
         (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 2 = 0 AS rises
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY 3 * source_size / weight, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked),
aims AS (
  SELECT source, source_size, weight, weight * if(rises, 0.5, 1.5)::DOUBLE AS w0, least(3.0 * source_size,
         coalesce((SELECT max(level) FROM levels WHERE level <= 3 * source_size / weight) * weight, 3.0 * source_size))::DOUBLE AS target
  FROM levels),
lined AS (
  SELECT d.doc_id, d.size, a.source_size, a.target, a.weight, a.w0,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN aims a ON d.source IS NOT DISTINCT FROM a.source),
turned AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM lined),
final AS (
  SELECT *, greatest(0, least(size, CAST(round(target) AS BIGINT) - whole * source_size - before)) AS cut,
         CASE WHEN target > 0 THEN (before::DOUBLE * weight) / target END AS area, (2 * weight - w0) - w0 AS rise FROM turned)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(whole * size + cut AS BIGINT) AS taken,
       CASE WHEN whole * size + cut > 0 THEN
         CASE WHEN area >= weight THEN 1.0 ELSE least(1.0, (2 * area) / (w0 + sqrt(greatest(0.0, w0 * w0 + (2 * rise) * area)))) END END AS position
FROM final
"""
