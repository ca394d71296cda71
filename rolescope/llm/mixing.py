"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolescope.llm.base import fresh, materialize

WORD = r"[^\x20\x09-\x0D]+"
# Leading hex digits of the order hash that form a bucket: 4096 buckets a source.
BUCKET_DIGITS = 3


@dataclass(frozen=True)
class Curriculum:
    """Weights by rank of the source, the most repeats of a document, and weight schedules.

    A schedule is the source's rate at points of training time from 0 to 1, linear in between.
    ``schedules`` are given by source; any other source uses ``by_weight`` of its weight.
    """

    weights: tuple[int, ...] = (1, 2, 3)
    max_repeats: int = 3
    schedules: dict[str, tuple[tuple[float, float], ...]] = field(default_factory=dict)

    def by_weight(self, weight: int) -> tuple[tuple[float, float], ...]:
        """Light sources fade out, heavy ones fade in."""
        top = max(self.weights) + 1
        return ((0.0, float(top - weight)), (1.0, float(weight)))


def _segments(knots: tuple[tuple[float, float], ...]) -> Column:
    """Array of (t0, t1, r0, r1, c0, c1): the schedule and its integral, piece by piece."""
    total = sum((t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(knots, knots[1:]))
    parts, done = [], 0.0
    for (t0, r0), (t1, r1) in zip(knots, knots[1:]):
        area = (t1 - t0) * (r0 + r1) / 2 / total
        parts.append(F.struct(*[F.lit(float(v)).alias(n) for n, v in (
            ("t0", t0), ("t1", t1), ("r0", r0 / total), ("r1", r1 / total),
            ("c0", done), ("c1", done + area))]))
        done += area
    return F.array(*parts)


def _when_demanded(u: Column, segments: Column) -> Column:
    """Training time at which a share ``u`` of the source's demand has been drawn."""
    reached = F.filter(segments, lambda s: s["c0"] <= u)
    s = F.element_at(reached, -1)
    need = F.greatest(u - s["c0"], F.lit(0.0))
    slope = (s["r1"] - s["r0"]) / (s["t1"] - s["t0"])
    root = F.sqrt(F.greatest(s["r0"] * s["r0"] + 2.0 * slope * need, F.lit(0.0)))
    step = F.when(slope == 0, need / s["r0"]).otherwise((root - s["r0"]) / slope)
    return s["t0"] + step


def source_targets(sizes: DataFrame, plan: Curriculum) -> DataFrame:
    """``source, weight, source_size, target``, one row per source.

    Sources are ranked by code point, NULL last. All sizes are shared by weight; a target stops at
    ``max_repeats`` times its source's size and what is left over is shared again. The final level
    has a closed form: with sources ordered by cap per weight, it is the largest of the levels that
    would hold if all sources before had stopped. Windows here run over one row per source.
    """
    weights = F.array(*map(F.lit, plan.weights))
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("weight", F.element_at(weights, F.expr(
        f"int((row_number() over (order by source nulls last) - 1) % {len(plan.weights)} + 1)")))
    cap = F.col("source_size") * plan.max_repeats
    everything = Window.partitionBy()
    before = Window.orderBy(cap / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    left = (F.sum("source_size").over(everything)
            - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * plan.max_repeats)
    open_weight = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(before), F.lit(0))
    levels = ranked.withColumn("level", left.cast("double") / open_weight)
    level = F.max("level").over(everything)
    return levels.select("source", "weight", "source_size",
                         F.least(level * F.col("weight"), cap.cast("double")).alias("target"))


def mix_plan(docs: DataFrame, plan: Curriculum = Curriculum(), id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id, size, source, source_size, target, copies, taken, first_position`` per row.

    Every document is taken ``floor(target / source size)`` times; what the source still lacks is
    filled by documents in hash order of their id, until the next one would overshoot by more than
    half of it. ``first_position`` is the training time (0 to 1) of a document's first copy: the
    point at which the integrated schedule of its source has demanded the words before it. It is
    NULL if the document is not taken.

    Running sums do not put a source into one task: the order hash cuts each source into 4096
    buckets, sums are taken within buckets and over bucket totals. NULL text is empty, NULL source
    is a source of its own, NULL or repeated ids are ordered by size after the hash. Empty tables
    give no rows; other columns are ignored.
    """
    key = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    sizes = materialize(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                    F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0))
                    .cast("bigint").alias("size"))
        .withColumn("order", key)
        .withColumn("bucket", F.substring("order", 1, BUCKET_DIGITS)), "mix-sizes")
    targets = source_targets(sizes, plan)
    given = F.lit(None)
    for weight in dict.fromkeys(plan.weights):
        given = F.when(F.col("weight") == weight, _segments(plan.by_weight(weight))).otherwise(given)
    for source, knots in plan.schedules.items():
        given = F.when(F.col("source") == source, _segments(knots)).otherwise(given)
    targets = materialize(targets.withColumn("schedule", given), "mix-targets")
    in_source = Window.partitionBy("b_source").orderBy("b_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    buckets = (sizes.groupBy(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"))
               .agg(F.sum("size").alias("n"))
               .withColumn("before", F.coalesce(F.sum("n").over(in_source), F.lit(0))).drop("n"))
    in_bucket = Window.partitionBy("source", "bucket").orderBy("order", "id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    running = (sizes.withColumn("within", F.coalesce(F.sum("size").over(in_bucket), F.lit(0)))
               .join(buckets, F.col("source").eqNullSafe(F.col("b_source"))
                     & (F.col("bucket") == F.col("b_bucket")))
               .withColumn("start", F.col("before") + F.col("within"))
               .drop("b_source", "b_bucket"))
    joined = running.join(targets.withColumnRenamed("source", "t_source"),
                          F.col("source").eqNullSafe(F.col("t_source")))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
                  ).otherwise(0).cast("bigint")
    rest = F.col("target") - F.col("full") * F.col("source_size")
    extra = (F.col("full") < plan.max_repeats) & (F.col("start") + F.col("size") / 2.0 <= rest)
    out = (joined.withColumn("full", full)
           .withColumn("copies", F.col("full") + extra.cast("bigint"))
           .withColumn("taken", F.col("size") * F.col("copies")))
    share = F.when(F.col("target") > 0, F.col("start") / F.col("target")).otherwise(0.0)
    return out.select(
        F.col("id").alias(id_col), "size", F.col("source").alias(source_col), "source_size",
        "target", "copies", "taken",
        F.when(F.col("copies") > 0, _when_demanded(share, F.col("schedule"))
               ).alias("first_position"),
        "start", "schedule")


def training_order(planned: DataFrame, id_col: str = "doc_id",
                   source_col: str = "source") -> DataFrame:
    """``id, source, start, size, copy, position``: every copy of a plan, in training order.

    ``planned`` is the result of ``mix_plan``. Each copy stands where the integrated schedule of its
    source has demanded the words before it; all sources are range-sorted by that time into one
    sequence. Rows whose ``copies`` are 0 are not in it; (id, source, start, size) tells rows apart.
    """
    copies = F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)
    drawn = planned.where(F.col("copies") > 0).withColumn("copy", F.explode(copies))
    at = F.col("start") + F.col("copy") * F.col("source_size")
    share = F.when(F.col("target") > 0, at / F.col("target")).otherwise(0.0)
    return drawn.select(
        id_col, source_col, "start", "size", "copy",
        _when_demanded(share, F.col("schedule")).alias("position"),
    ).orderBy("position", id_col, source_col, "start", "copy")


def mixed_documents(docs: DataFrame, plan: Curriculum = Curriculum(), id_col: str = "doc_id",
                    text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``mix_plan`` with what the sequence of ``training_order`` holds of each.

    ``copies``, ``taken`` and ``first_position`` are counted in the sequence, which is written in
    training order and read back, not foretold from the plan. Rows that it does not hold have 0
    copies and no position.
    """
    planned = materialize(mix_plan(docs, plan, id_col, text_col, source_col), "mix-plan")
    sequence = materialize(training_order(planned, id_col, source_col), "mix-sequence")
    key = {id_col: "k_id", source_col: "k_source", "start": "k_start", "size": "k_size"}
    # rows that agree in all four are empty texts of one id: each has its own copy 0, 1, ...
    held = sequence.groupBy(*[F.col(c).alias(k) for c, k in key.items()]).agg(
        (F.count(F.lit(1)) / F.count_if(F.col("copy") == 0)).cast("bigint").alias("held"),
        F.min("position").alias("first"))
    same = F.lit(True)
    for c, k in key.items():
        same = same & F.col(c).eqNullSafe(F.col(k))
    copies = F.coalesce(F.col("held"), F.lit(0).cast("bigint"))
    return planned.join(held, same, "left").select(
        id_col, "size", source_col, "source_size", "target", copies.alias("copies"),
        (F.col("size") * copies).alias("taken"), F.col("first").alias("first_position"))


def mix(docs: DataFrame, plan: Curriculum = Curriculum(), id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: one row per copy taken, range-sorted by training position.

    Keeps all columns of ``docs`` and adds ``position`` (``position_`` where the table has such a
    column, and so on). Documents of which the mix takes no copy
    are left out. Rows that share an id take the copies of that id's smallest row.
    """
    planned = mix_plan(docs, plan, id_col, text_col, source_col)
    key, p, copy, position = (fresh(docs, c) for c in ("plan_id", "plan", "copy", "position"))
    per_id = planned.groupBy(F.col(id_col).alias(key)).agg(
        F.min_by(F.struct("copies", "start", "source_size", "target", "schedule"), "start")
        .alias(p))
    copies = F.sequence(F.lit(0).cast("bigint"), F.col(f"{p}.copies") - 1)
    joined = (docs.join(per_id, docs[id_col].eqNullSafe(per_id[key]))
              .where(F.col(f"{p}.copies") > 0).withColumn(copy, F.explode(copies)))
    at = F.col(f"{p}.start") + F.col(copy) * F.col(f"{p}.source_size")
    share = F.when(F.col(f"{p}.target") > 0, at / F.col(f"{p}.target")).otherwise(0.0)
    return (joined.withColumn(position, _when_demanded(share, F.col(f"{p}.schedule")))
            .drop(key, p, copy).orderBy(position, id_col))
