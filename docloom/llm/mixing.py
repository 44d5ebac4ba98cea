"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.checkpoints import materialise
from docloom.llm.common import WORD, plain_names, read

#: Slices of virtual time among which the place of the cut is sought, and the one that holds all late finishes.
SLICES, LAST_SLICE = 16384, 1 << 17


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, repeats: int) -> DataFrame:
    """(source, source_rank, source_size, target): weights repeat over the sources by code point, null last.

    The budget, `share` of all sizes, is split by weight; no target exceeds `repeats` times its source's size, what
    is over goes to the others by weight. In order of size by weight, the sources that are filled come first, so
    running sums tell which they are. One row per source in the one ordered window.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("source_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    place = (F.col("source_rank") - 1) % len(weights)
    weighted = ranked.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place + 1).cast("int")))
    weighted = weighted.withColumn("cap", F.col("source_size") * F.lit(float(repeats))).withColumn("fill", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    earlier = Window.orderBy("fill", "source_rank").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    )
    filled = weighted.withColumn("budget", F.sum("source_size").over(everything) * F.lit(share)).withColumn("full", F.col("fill") <= level)
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("cap")).otherwise(left / open_weight * F.col("weight"))
    return filled.select("source", "source_rank", "source_size", target.alias("target"))


def _finish(turn: Column) -> Column:
    """Virtual time at which a document's copy of that turn (from 0) is through its source's queue."""
    return F.when(F.col("target") > 0, (F.col("queued") + turn * F.col("source_size")) / F.col("target"))


def mix_plan(
    docs: DataFrame,
    weights: tuple[int, ...] = (5, 2, 1),
    share: float = 1.5,
    repeats: int = 2,
    seed: str = "mix",
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Per document: doc_id, tie, source, size, source_size, target, copies, taken.

    Each source's documents queue in the order of md5(seed, doc_id), all of them `repeats` times over. A copy's
    virtual finish time is the source's words up to it divided by the source's target; copies of all sources are
    ordered by finish time and cut where their words reach the budget. A source with a third of all rows is no one
    task's work: its queue is summed by slices of the shuffled order, then inside each slice; the cut is found by
    slices of virtual time, then inside the one slice in which the budget ends.

    A null text has size 0; a null source is a source of its own; a null doc_id queues as an empty one. Rows of
    equal doc_id are told apart by their text's hash (`tie`); fully equal rows are documents each. Empty tables
    give an empty result, sources of no words a target of 0. Other columns don't matter.
    """
    sizes = materialise(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
            F.xxhash64(text).alias("tie"),
            F.md5(F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))).alias("key"),
        ).withColumn("slice", F.substring("key", 1, 3)),
        "sizes",
    )
    targets = materialise(source_targets(sizes, weights, share, repeats), "targets")
    up_to_here = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = sizes.groupBy("source", "slice").agg(F.sum("size").alias("n")).withColumn("offset", F.coalesce(F.sum("n").over(up_to_here), F.lit(0)))
    slices = slices.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), F.col("slice").alias("l"), "offset", "source_rank", "source_size", "target"
    )
    inside = Window.partitionBy("source", "slice").orderBy("key", "doc_id", "tie").rowsBetween(Window.unboundedPreceding, 0)
    queued = sizes.withColumn("queued", F.sum("size").over(inside)).join(
        slices, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("l"))
    )
    queued = queued.withColumn("queued", F.col("queued") + F.col("offset"))
    queue = materialise(queued.select("doc_id", "tie", "source", "source_rank", "size", "source_size", "target", "key", "queued"), "queue")

    when = F.struct(F.col("finish"), F.col("source_rank"), F.col("key"), F.col("queued"), F.col("turn"))
    copies = queue.select("*", F.explode(F.array(*(F.lit(t) for t in range(repeats)))).alias("turn")).withColumn("finish", _finish(F.col("turn")))
    copies = copies.where("finish is not null").withColumn("at", F.least(F.floor(F.col("finish") * SLICES), F.lit(LAST_SLICE)))
    budget = (targets.agg(F.sum("source_size")).first()[0] or 0) * share
    totals = copies.groupBy("at").agg(F.sum("size").alias("n")).withColumn(
        "through", F.sum("n").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    )
    cut = totals.where(F.col("through") > budget).orderBy("at").limit(1).first()
    taken = []
    if cut is not None:
        last = copies.where(F.col("at") == cut["at"]).withColumn("when", when)
        last = last.withColumn("through", F.sum("size").over(Window.partitionBy("at").orderBy("when").rowsBetween(Window.unboundedPreceding, 0)))
        bound = last.where(F.col("through") + (cut["through"] - cut["n"]) <= budget).agg(F.max("when").alias("w")).first()["w"]
    for t in range(repeats):
        c = F.col("f").isNotNull()
        finish = _finish(F.lit(t))
        if cut is not None:
            at = F.least(F.floor(finish * SLICES), F.lit(LAST_SLICE))
            own = F.struct(finish.alias("finish"), F.col("source_rank"), F.col("key"), F.col("queued"), F.lit(t).alias("turn"))
            c = at < cut["at"]
            if bound is not None:
                c = c | ((at == cut["at"]) & (own <= F.struct(*(F.lit(bound[k]).alias(k) for k in bound.asDict()))))
            c = F.coalesce(c, F.lit(False))
        else:
            c = finish.isNotNull()
        taken.append(c.cast("int"))
    number = sum(taken[1:], taken[0])
    return queue.select("doc_id", "tie", "source", "size", "source_size", F.col("target"), number.alias("copies"), (F.col("size") * number).alias("taken"))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """The rows of `docs` that the mix takes, each as often as it is taken, with the columns of `docs`.

    Rows equal in id, source and text are one document that the plan may hold several times.
    """
    plain, (doc_id, source, text) = plain_names(docs, doc_id, source, text)
    plan = mix_plan(plain, doc_id=doc_id, source=source, text=text, **how)
    plan = plan.groupBy(F.col("doc_id").alias("__d"), F.col("source").alias("__s"), F.col("tie").alias("__t")).agg(F.sum("copies").alias("__n")).where("__n > 0")
    tied = plain.withColumn("__tie", F.xxhash64(text)).dropDuplicates([doc_id, source, "__tie"])
    same = F.col(doc_id).eqNullSafe(F.col("__d")) & F.col(source).eqNullSafe(F.col("__s")) & (F.col("__tie") == F.col("__t"))
    return tied.join(plan, same).withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*plain.columns).toDF(*docs.columns)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(read(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


OP7_SQL = r"""
with sizes as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         md5('mix' || coalesce(cast(doc_id as varchar), '')) as key
  from documents),
per as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as source_rank from sizes group by source),
weighted as (
  select *, [5.0::double, 2.0::double, 1.0::double][((source_rank - 1) % 3) + 1] as weight, source_size * 2.0::double as cap,
         sum(source_size) over () * 1.5::double as budget from per),
leveled as (
  select *, cap / weight <= (budget - coalesce(sum(cap) over e, 0)) / (sum(weight) over () - coalesce(sum(weight) over e, 0)) as is_full
  from weighted window e as (order by cap / weight, source_rank rows between unbounded preceding and 1 preceding)),
targets as (
  select source, source_rank, source_size, budget, case when is_full then cap else
    (budget - coalesce(sum(case when is_full then cap end) over (), 0)) / (sum(case when not is_full then weight end) over ()) * weight end as target
  from leveled),
queued as (
  select s.doc_id, s.source, s.size, s.key, t.source_rank, t.source_size, t.target, t.budget,
         sum(s.size) over (partition by s.source order by s.key, s.doc_id rows unbounded preceding) as queued
  from sizes s join targets t on s.source is not distinct from t.source),
copies as (
  select *, (queued + turn * source_size) / target as finish from queued, (values (0), (1)) as v(turn) where target > 0),
through as (
  select *, sum(size) over (order by finish, source_rank, key, queued, turn rows unbounded preceding) as through from copies),
taken as (select doc_id, count(*) as copies from through where through <= budget group by doc_id)
select q.doc_id, q.source, q.size, q.source_size, q.target, coalesce(t.copies, 0)::int as copies, (q.size * coalesce(t.copies, 0))::bigint as taken
from queued q left join taken t on q.doc_id = t.doc_id
"""
