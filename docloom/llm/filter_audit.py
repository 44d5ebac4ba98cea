"""Audit of filters that act one after the other: what each removes in every order, and its Shapley value.

Each document is reduced to the set of filters that it fails. A coalition of filters removes what fails any of them; the
removals of all coalitions, tabulated per part of the corpus, answer every order: what a filter removes at a step is the
difference of two coalitions. The Shapley value is the solution of a least squares problem over all coalitions, weighted
by the kernel and constrained to add up to what all filters remove. Its normal equations are solved exactly, in rationals,
once: the solution is linear in the removals, so it is a whole-numbered row of coefficients for each filter.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.checkpoints import materialise
from docloom.llm.common import WORD, batch, map_batches, read, utf8

FILTERS = "ABCDE"
_CAPITALS, _SIGNS, _CONTINUED = bytes(range(65, 91)), b"#$%&*|", bytes(range(0x80, 0xC0))


def solved(rows: list[list[Fraction]]) -> list[list[Fraction]]:
    """A square system with its right sides in the same rows, solved exactly: the solutions, a row per unknown."""
    rows, n = [list(r) for r in rows], len(rows)
    for i in range(n):
        at = next(k for k in range(i, n) if rows[k][i])
        rows[i], rows[at] = rows[at], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(n):
            if k != i and rows[k][i]:
                rows[k] = [x - rows[k][i] * y for x, y in zip(rows[k], rows[i], strict=True)]
    return [r[n:] for r in rows]


def shapley_coefficients(n: int) -> list[list[int]]:
    """For each of n filters, what each coalition (as bits) counts in n! times its Shapley value.

    Minimises the sum over coalitions S, neither empty nor whole, of w(S) (v(S) - sum of phi in S)^2 with w(S) = (n - 1) /
    (C(n, |S|) |S| (n - |S|)), such that all phi add up to v(whole). The right side is left open: a column per coalition.
    """
    every, whole = range(1 << n), (1 << n) - 1
    weight = {s: Fraction(n - 1, comb(n, k) * k * (n - k)) for s in every if 0 < (k := s.bit_count()) < n}
    has = lambda s, i: s >> i & 1
    rows = [
        [*(sum((w for s, w in weight.items() if has(s, i) and has(s, j)), Fraction(0)) for j in range(n)), Fraction(1), *(weight.get(s, Fraction(0)) * has(s, i) for s in every)]
        for i in range(n)
    ]
    rows.append([*([Fraction(1)] * n), Fraction(0), *(Fraction(s == whole) for s in every)])
    return [[int(x * factorial(n)) for x in r] for r in solved(rows)[:n]]


def failures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(doc_id, part, digest, fails): per row which of the filters A to D its whole text fails, as bits, and the SHA-256
    of the text. A null text counts as empty, a null part is the empty string. Narrow."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        fails, digests = [], []
        for t in utf8(b.column("text")):
            words = t.split()
            n, chars = len(words), len(t.translate(None, _CONTINUED))
            fails.append(
                (n < 50) + 2 * (100 * len(set(words)) < 65 * n) + 4 * (100 * (len(t) - len(t.translate(None, _CAPITALS))) > 5 * chars) + 8 * (len(t.translate(None, _SIGNS)) < len(t))
            )
            digests.append(hashlib.sha256(t).digest())
        return batch(doc_id=b.column("doc_id"), part=b.column("part"), digest=pa.array(digests, pa.binary()), fails=pa.array(fails, pa.int32()))

    source = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), F.col(f"`{text}`").alias("text"))
    return map_batches(source, each, "doc_id long, part string, digest binary, fails int")


def failure_counts(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """(part, fails, good, toxic, n): rows by the filters that they fail (A to E as bits 1 to 16) and their labels.

    E fails where a smaller id has the same text. Texts are told by their SHA-256: the smallest id of each is a grouped
    minimum, and the rows that bear it are found by (digest, id), so a text that stands in a third of all rows is no hot
    key. A null id is neither smaller nor larger than others: it doesn't fail E. A label counts if any of a document's
    label rows has it.
    """
    rows = materialise(failures(docs, doc_id, text, part), "failures")
    told = labels.groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    keys = ["part", "fails", "good", "toxic"]
    by_id = rows.groupBy("digest", "doc_id", "part", "fails").agg(F.count(F.lit(1)).alias("n"))
    least = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    first = by_id.join(least.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left")
    again = F.when(F.col("first").isNull() & F.col("doc_id").isNotNull(), 16).otherwise(0)
    labelled = first.withColumn("fails", F.col("fails") + again).join(told, "doc_id", "left")
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    return labelled.select("part", "fails", *flags, "n").groupBy(*keys).agg(F.sum("n").alias("n"))


def filter_audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Per part, order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    `labels` has doc_id, quality and toxic. Null texts count as empty, null parts as the empty string, repeated rows each;
    an empty table gives no rows; other columns are ignored. Texts are read once, whole; what is shuffled is a narrow row
    a document, and beyond that at most 128 rows a part.
    """
    counts = failure_counts(docs, labels, doc_id, text, part)
    n, every = len(FILTERS), range(1 << len(FILTERS))
    removed = lambda s, cond: F.sum(F.when((F.col("fails").bitwiseAND(F.lit(s)) != 0) & cond, F.col("n")).otherwise(0))
    true = F.lit(True)
    tables = counts.groupBy("part").agg(
        F.sum("n").alias("total"), *(F.array(*(removed(s, cond) for s in every)).alias(name) for name, cond in (("v", true), ("g", F.col("good")), ("t", F.col("toxic"))))
    )
    times = lambda row: sum((F.get("v", F.lit(s)) * k for s, k in enumerate(row) if k), F.lit(0))
    values = tables.withColumn("phi", F.array(*(times(row) for row in shapley_coefficients(n))))
    steps = []
    for order in permutations(range(n)):
        before = 0
        for k, i in enumerate(order, 1):
            steps.append(("".join(FILTERS[j] for j in order), k, i, before, before | 1 << i))
            before |= 1 << i
    shape = "array<struct<filter_order: string, step: int, i: int, before: int, after: int>>"
    listed = F.from_json(F.lit("[" + ",".join(f'{{"filter_order":"{o}","step":{k},"i":{i},"before":{b},"after":{a}}}' for o, k, i, b, a in steps) + "]"), shape)
    rows = values.select("*", F.explode(listed).alias("s")).select("*", "s.*")
    at = F.get(F.array(*(F.lit(1 << i) for i in range(n))), F.col("i"))
    gain = lambda table: F.get(table, F.col("after")) - F.get(table, F.col("before"))
    whole = F.lit((1 << n) - 1)
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - F.get("v", F.col("after"))).alias("kept"), gain("v").alias("removed"), (F.get("v", at) - gain("v")).alias("redundant"),
        (F.get("v", whole) - F.get("v", whole - at)).alias("unique_fails"), gain("g").alias("good_lost"), gain("t").alias("toxic_lost"), F.get("phi", F.col("i")).alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


OP13_SQL = rf"""
with w as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{WORD}') as words from documents),
f as (
  select doc_id, part, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
    regexp_matches(t, '[#$%&*|]'), doc_id > min(doc_id) over (partition by t)] as fails from w),
d as (
  select part, fails, coalesce(good, false) as good, coalesce(toxic, false) as toxic, count(*) as n from f
  left join (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by 1) using (doc_id) group by all),
l as (select unnest([1, 2, 3, 4, 5]) as i),
orders as (
  select [a.i, b.i, c.i, x.i, e.i] as o from l a, l b, l c, l x, l e
  where len(list_distinct([a.i, b.i, c.i, x.i, e.i])) = 5),
steps as (select o, array_to_string(list_transform(o, lambda i: substr('ABCDE', i, 1)), '') as filter_order, s.i as step from orders, l s),
told as (
  select part, filter_order, step, o[step] as i, n, good, toxic, fails[o[step]] as own,
    len(list_filter(o[1:step - 1], lambda i: fails[i])) > 0 as gone, len(list_filter(fails, lambda x: x)) as failed from d, steps),
rows as (
  select part, filter_order, step, i, sum(n) filter (not gone and not own) as kept, sum(n) filter (own and not gone) as removed, sum(n) filter (own and gone) as redundant,
    sum(n) filter (own and failed = 1) as unique_fails, sum(n) filter (own and not gone and good) as good_lost, sum(n) filter (own and not gone and toxic) as toxic_lost
  from told group by all)
select part, filter_order, step, cast(coalesce(kept, 0) as bigint) as kept, cast(coalesce(removed, 0) as bigint) as removed, cast(coalesce(redundant, 0) as bigint) as redundant,
  cast(coalesce(unique_fails, 0) as bigint) as unique_fails, cast(coalesce(good_lost, 0) as bigint) as good_lost, cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
  cast(coalesce(sum(removed) over (partition by part, i), 0) as bigint) as shapley
from rows
"""
