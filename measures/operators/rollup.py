"""Daily roll-up (A1) and its two merge rules (A5 faithful, A6 exact).

Bucket key: (agg_day, study_id, site_id, participant_id, measurement_type).
All aggregates are algebraic, so Spark computes them partially on the map
side before the shuffle; a hot participant or site does not land whole in
one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from measures.functions.parsing import as_day, is_low_quality
from measures.schema import ROLLUP_KEYS

MEASURES = ("measurement_count", "avg_value", "min_value", "max_value", "avg_systolic",
            "avg_diastolic", "avg_quality_score", "low_quality_count")

# Partial sums kept by the exact roll-up (A6): avg = sum / non-null count.
_PARTIALS = (("value", "value_num"), ("systolic", "bp_systolic"),
             ("diastolic", "bp_diastolic"), ("quality", "quality_score"))


def exact_avg(c: Column | str) -> Column:
    """AVG of a DECIMAL column computed exactly and returned as DOUBLE."""
    c = F.col(c) if isinstance(c, str) else c
    return F.try_divide(F.sum(c), F.count(c)).cast("double")


def daily_rollup(facts: DataFrame) -> DataFrame:
    """A1: collapse measurements into daily buckets."""
    return (facts
            .groupBy(as_day("timestamp").alias("agg_day"), *ROLLUP_KEYS[1:])
            .agg(F.count(F.lit(1)).alias("measurement_count"),
                 F.avg("value_num").alias("avg_value"),
                 F.min("value_num").alias("min_value"),
                 F.max("value_num").alias("max_value"),
                 F.avg("bp_systolic").alias("avg_systolic"),
                 F.avg("bp_diastolic").alias("avg_diastolic"),
                 exact_avg("quality_score").alias("avg_quality_score"),
                 F.sum(is_low_quality("quality_score").cast("int")).cast("long")
                  .alias("low_quality_count")))


def merge_faithful(old: DataFrame, new: DataFrame) -> DataFrame:
    """A5: merge a batch roll-up into the stored one with the reference's rule.

    Counts add; min/max take LEAST/GREATEST (NULL-skipping); averages are
    weighted by the bucket row count (not the non-NULL count); a NULL on either
    side makes avg_value, avg_quality_score and low_quality_count NULL, while
    systolic/diastolic fall back to the old average.  A bucket present on one
    side only is taken verbatim.  (Traps T11-T14.)
    """
    o = old.select(*ROLLUP_KEYS, *[F.col(m).alias("o_" + m) for m in MEASURES])
    n = new.select(*ROLLUP_KEYS, *[F.col(m).alias("n_" + m) for m in MEASURES])
    j = o.join(n, list(ROLLUP_KEYS), "full_outer")
    oc, nc = F.col("o_measurement_count"), F.col("n_measurement_count")
    both = oc.isNotNull() & nc.isNotNull()
    total = oc + nc

    def weighted(m: str, denominator: Column = total) -> Column:
        return (F.col("o_" + m) * oc + F.col("n_" + m) * nc) / denominator

    merged = {
        "measurement_count": total,
        "min_value": F.least("o_min_value", "n_min_value"),
        "max_value": F.greatest("o_max_value", "n_max_value"),
        "low_quality_count": F.col("o_low_quality_count") + F.col("n_low_quality_count"),
        "avg_value": weighted("avg_value"),
        "avg_systolic": F.coalesce(weighted("avg_systolic", F.nullif(total, F.lit(0))),
                                   F.col("o_avg_systolic")),
        "avg_diastolic": F.coalesce(weighted("avg_diastolic", F.nullif(total, F.lit(0))),
                                    F.col("o_avg_diastolic")),
        "avg_quality_score": weighted("avg_quality_score"),
    }
    out = [F.when(both, merged[m]).when(oc.isNotNull(), F.col("o_" + m))
           .otherwise(F.col("n_" + m)).alias(m) for m in MEASURES]
    return j.select(*ROLLUP_KEYS, *out)


def rollup_partials(facts: DataFrame) -> DataFrame:
    """A6 input: per bucket, counts and sums from which averages are exact."""
    aggs = [F.count(F.lit(1)).alias("measurement_count"),
            F.min("value_num").alias("min_value"), F.max("value_num").alias("max_value"),
            F.sum(is_low_quality("quality_score").cast("int")).cast("long")
             .alias("low_quality_count")]
    for name, src in _PARTIALS:
        # Quality stays DECIMAL: its sum is exact and, at SUM's natural
        # precision, the final division keeps its scale (a wider type would
        # make Spark cut the quotient to 6 places).
        c = F.col(src) if name == "quality" else F.col(src).cast("double")
        aggs += [F.sum(c).alias(f"sum_{name}"), F.count(src).alias(f"n_{name}")]
    return facts.groupBy(as_day("timestamp").alias("agg_day"), *ROLLUP_KEYS[1:]).agg(*aggs)


def row_partials(facts: DataFrame) -> DataFrame:
    """`rollup_partials` of each row alone, to be combined by `merge_exact`: rows
    and stored sums then meet in one aggregation."""
    cols = [F.lit(1).cast("long").alias("measurement_count"),
            F.col("value_num").alias("min_value"), F.col("value_num").alias("max_value"),
            is_low_quality("quality_score").cast("long").alias("low_quality_count")]
    for name, src in _PARTIALS:
        c = F.col(src) if name == "quality" else F.col(src).cast("double")
        cols += [c.alias(f"sum_{name}"), F.col(src).isNotNull().cast("long").alias(f"n_{name}")]
    return facts.select(as_day("timestamp").alias("agg_day"), *ROLLUP_KEYS[1:], *cols)


def merge_exact(*partials: DataFrame) -> DataFrame:
    """Combine any number of partial roll-ups; equal to a recompute."""
    u = partials[0]
    for p in partials[1:]:
        u = u.unionByName(p)
    aggs = [F.sum("measurement_count").cast("long").alias("measurement_count"),
            F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
            F.sum("low_quality_count").cast("long").alias("low_quality_count")]
    for name, _ in _PARTIALS:
        aggs += [F.sum(f"sum_{name}").alias(f"sum_{name}"),
                 F.sum(f"n_{name}").cast("long").alias(f"n_{name}")]
    return u.groupBy(*ROLLUP_KEYS).agg(*aggs)


# Stored type of the quality sum in a partial roll-up: exact for any realistic
# bucket, and narrow enough that the final division keeps 12 decimal places.
QUALITY_SUM_TYPE = "decimal(28,2)"


def stored_partials(partials: DataFrame) -> DataFrame:
    """Partial roll-up with the fixed column types of the stored table."""
    return partials.withColumn("sum_quality", F.col("sum_quality").cast(QUALITY_SUM_TYPE))


def finalize_partials(partials: DataFrame) -> DataFrame:
    """Partial roll-up -> the roll-up layout of A1."""
    def avg(name: str) -> Column:
        return F.try_divide(F.col(f"sum_{name}"), F.col(f"n_{name}")).cast("double")
    return partials.select(*ROLLUP_KEYS, "measurement_count", avg("value").alias("avg_value"),
                           "min_value", "max_value", avg("systolic").alias("avg_systolic"),
                           avg("diastolic").alias("avg_diastolic"),
                           avg("quality").alias("avg_quality_score"), "low_quality_count")
