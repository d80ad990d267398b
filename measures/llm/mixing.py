"""Mixing sources to target weights by Pfair scheduling, in DataFrame terms.

The rows of a source are laid out in a fixed pseudo-random order and cut into
blocks.  With integer shares e (sum P over the sources still supplied), block
k = 1, 2, ... of a source is released at slot floor((k-1)P/e) and due by slot
ceil(kP/e).  Earliest-deadline-first over the released blocks meets every
deadline, so that after any slot each source has had its share of the slots
within less than one block, early or late.  The schedule repeats every P slots, so only one
period is scheduled (a fold over P slots in one row) and each block finds its
slot by arithmetic; the rows themselves are shuffled once, as (id, source).

When a source runs out, the next period is scheduled anew for the remaining
sources with their shares; inside the last period of a source its unused slots
stay empty.  No row is dropped or repeated.

Rules
- a null source is a source of its own; sources without a stated share have
  `default_share`; an empty table gives no rows.
- rows are laid out by md5 of the id, then the id; rows that share an id (a
  null id included) are told apart by their remaining columns' order of
  arrival only, and identical rows are interchangeable.
- up to `max_plan_slots` (the number of sources times the sum of shares) the plan
  is broadcast; above it the same schedule is made as one row per source and
  period, joined by a shuffle (`schedule_rows`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from measures.llm.common import cut_lineage

BLOCK_ROWS = 8
BUCKET_ROWS = 20_000
MIN_BUCKETS = 256
MAX_PLAN_SLOTS = 4_000_000


def mix(docs: DataFrame, shares: dict[str, int], default_share: int = 1,
        block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", source_col: str = "source",
        max_plan_slots: int = MAX_PLAN_SLOTS, whole_rows: bool = False) -> DataFrame:
    """Per row: id, source, block (1, 2, ... in its source), release, deadline
    and slot (from 0, over the whole mix), place (1, 2, ... in its block), and
    with `whole_rows` the row itself as a struct `row`.  Ordering by (slot,
    place) gives the mix."""
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")).alias("key"),  # never null
        *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if whole_rows else []))
    placed = number_within_source(rows)
    counts = cut_lineage(rows.groupBy("key", "source").agg(F.count(F.lit(1)).alias("n")))
    sized = size_up(counts, shares, default_share, block_rows)
    size = sized.agg((F.count(F.lit(1)) * F.sum("share")).alias("slots")).first()["slots"] or 0
    block = F.floor((F.col("nth") - 1) / F.lit(block_rows)).cast("bigint")
    out = placed.withColumn("b", block)
    carried = ["row"] if whole_rows else []
    if size <= max_plan_slots:
        out = (out.join(F.broadcast(schedule(sized)), "key")
               .withColumn("period", F.expr("b div share"))
               .withColumn("phase", F.expr("filter(phases, p -> period < p.until)[0]")))
    else:
        out = (out.withColumn("share", share_of(F.col("source"), shares, default_share))
               .withColumn("period", F.expr("b div share"))
               .join(schedule_rows(sized, shares, default_share), ["key", "period"]))
    out = out.withColumn("k", F.expr("b % share"))
    base = F.expr("phase.first_slot + (period - phase.since) * phase.length")
    return out.select(
        "id", "source", (F.col("b") + 1).alias("block"),
        (base + F.expr("(k * phase.length) div share")).alias("release"),
        (base + F.expr("((k + 1) * phase.length + share - 1) div share")).alias("deadline"),
        (base + F.expr("phase.slots[cast(k as int)]")).alias("slot"),
        (F.expr(f"(nth - 1) % {int(block_rows)}") + 1).alias("place"), *carried)


def number_within_source(rows: DataFrame) -> DataFrame:
    """nth = 1, 2, ... within each source, without gathering a source in one
    task: rows are numbered within (source, hash bucket), and each bucket
    starts where the buckets before it end."""
    n = rows.count()
    buckets = MIN_BUCKETS
    while buckets * BUCKET_ROWS < n:
        buckets *= 2
    key = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    bucket = (F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint") * buckets
              / F.lit(1 << 32)).cast("int")  # equal parts of the md5 order
    rows = rows.withColumns({"h": key, "bucket": bucket})
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = (rows.groupBy("key", "bucket").agg(F.count(F.lit(1)).alias("m"))
              .select("key", "bucket",
                      F.coalesce(F.sum("m").over(before), F.lit(0)).alias("before")))
    own = Window.partitionBy("key", "bucket").orderBy("h", "id")
    # The join finds the rows as the window left them: dealt by (key, bucket).
    return (rows.withColumn("rn", F.row_number().over(own)).join(starts, ["key", "bucket"])
            .withColumn("nth", F.col("before") + F.col("rn")).drop("h", "bucket", "before", "rn"))


def share_of(source: Column, shares: dict[str, int], default_share: int) -> Column:
    out = F.lit(int(default_share))
    for name, share in sorted(shares.items()):
        if int(share) < 1:
            raise ValueError(f"share of {name!r} must be a positive integer")
        out = F.when(source == F.lit(name), F.lit(int(share))).otherwise(out)
    return out.cast("bigint")


def size_up(counts: DataFrame, shares: dict[str, int], default_share: int,
            block_rows: int) -> DataFrame:
    """One row per source: its share, and how many blocks and periods it fills."""
    sized = counts.select(
        "key", share_of(F.col("source"), shares, default_share).alias("share"),
        F.ceil(F.col("n") / F.lit(block_rows)).cast("bigint").alias("blocks"))
    return sized.withColumn("periods", F.expr("(blocks + share - 1) div share"))


def schedule(sized: DataFrame) -> DataFrame:
    """One row per source: share and the phases of the mix, each with the
    slots of the source's blocks inside a period."""
    # Phase i: the periods in which the same sources are still supplied.
    phases = (sized.agg(F.sort_array(F.collect_list(
        F.struct("key", "share", "periods"))).alias("everyone"))
        .select("everyone", F.explode(F.expr("array_distinct(everyone.periods)")).alias("until"))
        .select("until", F.expr("filter(everyone, x -> x.periods >= until)").alias("live"))
        .withColumn("length", F.expr("aggregate(live, 0L, (n, x) -> n + x.share)")))
    order = Window.partitionBy(F.lit(0)).orderBy("until")  # at most one row per source
    phases = (phases.withColumn("since", F.coalesce(F.lag("until").over(order), F.lit(0)))
              .withColumn("first_slot", F.coalesce(
                  F.sum(F.expr("(until - since) * length")).over(
                      order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("order", F.expr(EARLIEST_DEADLINE_FIRST)))
    each = phases.select(
        "until", "since", "length", "first_slot",
        F.posexplode("live").alias("i", "one"), "order").select(
        F.col("one.key").alias("key"), F.col("one.share").alias("share"),
        F.struct("until", "since", "length", "first_slot",
                 F.expr("filter(transform(order, (x, t) -> if(x = i, t, null)), t -> t is not null)")
                 .alias("slots")).alias("phase"))
    return (each.groupBy("key", "share")
            .agg(F.sort_array(F.collect_list("phase")).alias("phases")))


# One period: at slot t, of the sources whose next block is released (release
# <= t), the one with the earliest deadline; ties go to the first in order.
EARLIEST_DEADLINE_FIRST = """
aggregate(
  sequence(0, cast(length - 1 as int)),
  named_struct('had', transform(live, x -> 0L), 'out', cast(array() as array<int>)),
  (s, t) -> transform(array(
    array_min(filter(
      transform(live, (x, i) -> if(
        s.had[i] < x.share AND (s.had[i] * length) div x.share <= t,
        named_struct('due', ((s.had[i] + 1) * length + x.share - 1) div x.share, 'i', i),
        null)),
      c -> c is not null)).i),
    p -> named_struct('had', transform(s.had, (h, i) -> if(i = p, h + 1, h)),
                      'out', concat(s.out, array(p))))[0],
  s -> s.out)
"""


def schedule_rows(sized: DataFrame, shares: dict[str, int], default_share: int) -> DataFrame:
    """The schedule as one row per source and period, for any number of sources.

    Sources without a stated share are alike: their blocks are due in the order
    of (k, key) and take the slots that the others leave, one after another.  So
    one period is folded over the state of the stated sources alone, one row per
    phase, and every other source finds its slots by its rank in the phase."""
    names = sorted(("=" + name for name in shares), key=lambda x: x.encode())
    other = ~F.col("key").isin(names) if names else F.lit(True)
    down = Window.partitionBy(F.lit(0)).orderBy(F.desc("until"))  # a row per phase, none per source
    up = Window.partitionBy(F.lit(0)).orderBy("until")

    def tally(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0)).cast("bigint")

    phases = sized.groupBy(F.col("periods").alias("until")).agg(
        F.sum("share").alias("length"), tally(other).alias("others"),
        *[tally(F.col("key") == F.lit(x)).alias(f"on{i}") for i, x in enumerate(names)],
        *[tally(other & (F.col("key") < F.lit(x))).alias(f"before{i}")
          for i, x in enumerate(names)])
    phases = phases.withColumns({c: F.sum(c).over(down) for c in phases.columns if c != "until"})
    stated = F.array(*[F.struct(
        F.lit(x).alias("key"), F.lit(int(shares[x[1:]])).cast("bigint").alias("share"),
        F.col(f"before{i}").alias("before"), F.col(f"on{i}").alias("on"))
        for i, x in enumerate(names)]) if names else F.expr(
        "cast(array() as array<struct<key:string,share:bigint,before:bigint,on:bigint>>)")
    phases = (phases.withColumn("stated", F.filter(stated, lambda x: x["on"] > 0))
              .select("until", "length", "others", "stated",
                      F.lit(int(default_share)).cast("bigint").alias("each"))
              .withColumn("since", F.coalesce(F.lag("until").over(up), F.lit(0)))
              .withColumn("first_slot", F.coalesce(
                  F.sum(F.expr("(until - since) * length")).over(
                      up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    phases = cut_lineage(phases.repartition("until").withColumn("taken", F.expr(STATED_FIRST)))
    periods = phases.withColumn("period", F.explode(F.expr("sequence(since, until - 1)")))
    lives = sized.withColumn("period", F.explode(F.expr("sequence(0L, periods - 1)")))
    first = (lives.where(other).join(phases.select(F.col("since").alias("period"), "until"),
                                     "period")
             .withColumn("rank", F.row_number().over(
                 Window.partitionBy("until").orderBy("key")).cast("bigint") - 1)
             .select("key", "until", "rank"))
    rows = lives.select("key", "period").join(periods, "period").join(
        first, ["key", "until"], "left")
    slots = F.expr("""if(rank is null,
        transform(filter(taken, x -> stated[x.j].key = key), x -> cast(x.t as bigint)),
        transform(transform(sequence(0L, each - 1), k -> k * others + rank),
                  q -> q + size(filter(taken, (x, i) -> x.t - i <= q))))""")
    return rows.select("key", "period", F.struct(
        "until", "since", "length", "first_slot", slots.alias("slots")).alias("phase"))


# The slots of one period that go to stated sources, as (slot t, source j).  The
# other sources' next block is the q-th of all theirs: the (q / others)-th of the
# source of rank q % others.  A stated source comes before the rank `before`.
STATED_FIRST = """
aggregate(
  sequence(0L, length - 1),
  named_struct('had', transform(stated, x -> 0L), 'q', 0L,
               'out', cast(array() as array<struct<t:bigint,j:int>>)),
  (s, t) -> transform(array(array_min(filter(
    concat(
      transform(stated, (x, j) -> if(
        s.had[j] < x.share AND (s.had[j] * length) div x.share <= t,
        named_struct('due', ((s.had[j] + 1) * length + x.share - 1) div x.share,
                     'place', x.before, 'kind', 0, 'j', j), null)),
      array(if(
        s.q < others * each AND ((s.q div greatest(others, 1L)) * length) div each <= t,
        named_struct('due', ((s.q div greatest(others, 1L) + 1) * length + each - 1) div each,
                     'place', s.q % greatest(others, 1L), 'kind', 1, 'j', -1), null))),
    c -> c is not null))),
    p -> named_struct(
      'had', transform(s.had, (h, j) -> if(j = p.j, h + 1, h)),
      'q', s.q + p.kind,
      'out', if(p.kind = 0, concat(s.out, array(named_struct('t', t, 'j', p.j))), s.out)))[0],
  s -> s.out)
"""
