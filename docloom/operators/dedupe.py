"""Windows over names, members and ids: one row of several, new ids, order in containers."""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docloom.checkpoints import materialise
from docloom.functions import numbers, paths
from docloom.operators.filters import first_seen, is_card
from docloom.operators.sinks import sorted_manifest, with_positions


def unique_cards(objects: DataFrame, key: str = "container_id") -> DataFrame:
    """WIN-2: objects (container_id, ord_path, name, card_id, deck_key, face_url, back_url) to the cards kept: the first
    of each (card id modulo 100, back, face) by ord_path, with repaired card ids. Shuffles by container and slot."""
    from docloom.operators.rewrite import fix_card_id

    cards = objects.where(is_card(F.col("name"))).withColumn("slot", F.pmod("card_id", F.lit(100)))
    one = F.row_number().over(Window.partitionBy(key, "slot", "back_url", "face_url").orderBy("ord_path"))
    kept = cards.withColumn("__n", one).where("__n = 1").drop("__n", "slot")
    return kept.withColumn("card_id", fix_card_id(F.col("deck_key"), F.col("card_id")))


def flatten_names(files: DataFrame, root: DataFrame | None = None) -> DataFrame:
    """WIN-3: files (path) with `name` and `moved`: the first of a bare name by (depth, path), unless the root has it."""
    told = files.select("path", paths.name(F.col("path")).alias("name"), F.size(F.split("path", "/")).alias("depth"))
    first = F.row_number().over(Window.partitionBy("name").orderBy("depth", "path")) == 1
    told = told.withColumn("first", first)
    if root is None:
        return told.select("path", "name", F.col("first").alias("moved"))
    there = root.select("name").distinct().withColumn("there", F.lit(True))
    return told.join(there, "name", "left").select("path", "name", (F.col("first") & F.col("there").isNull()).alias("moved"))


def unique_names(files: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """WIN-4: files (dir, stem, ext, ord) with `new_name`: stem, stem_1, stem_2 and so on within a folder, in order.

    A name that `existing` (dir, name) has is passed over: candidates of a stem are as many as its files plus its taken
    names, numbered again without the taken. Shuffles by folder, stem and extension.
    """
    key = ["dir", "stem", "ext"]
    ranked = files.withColumn("k", F.row_number().over(Window.partitionBy(*key).orderBy("ord")) - 1)
    shown = lambda k: F.concat("stem", F.when(k > 0, F.concat(F.lit("_"), k.cast("string"))).otherwise(""), "ext")
    if existing is None:
        return ranked.withColumn("new_name", shown(F.col("k"))).drop("k")
    counts = files.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    prefix = F.regexp_replace(F.regexp_replace("name", r"(?<=.)\.[^.]*$", ""), r"_\d+$", "")
    taken = existing.select("dir", prefix.alias("stem"), paths.suffix(F.col("name")).alias("ext")).groupBy(*key).agg(F.count(F.lit(1)).alias("t"))
    pool = counts.join(taken, key, "left").select(*key, F.explode(F.sequence(F.lit(0), F.col("n") + F.coalesce("t", F.lit(0)))).alias("c"))
    pool = pool.withColumn("new_name", shown(F.col("c"))).join(existing.select("dir", F.col("name").alias("new_name")).distinct(), ["dir", "new_name"], "left_anti")
    free = pool.withColumn("k", F.row_number().over(Window.partitionBy(*key).orderBy("c")) - 1).drop("c")
    return ranked.join(free, [*key, "k"]).drop("k")


def dedupe_deck_members(members: DataFrame, key: str = "container_id", carry: Sequence[str] = ()) -> DataFrame:
    """WIN-5, AGG-4: members (container_id, pos, deck_id, file) with `file` of the alphabetically first member of the
    same deck id and `discarded`, whether the own file goes. Order and multiplicity stay; `carry` names columns to keep."""
    keeper = F.min("file").over(Window.partitionBy(key, "deck_id"))
    return members.withColumn("keeper", keeper).select(key, "pos", "deck_id", F.col("keeper").alias("file"), (F.col("file") != F.col("keeper")).alias("discarded"), F.col("file").alias("old_file"), *carry)


def canonical_deck_ids(members: DataFrame, key: str = "container_id", carry: Sequence[str] = (), tasks: int | None = None) -> DataFrame:
    """WIN-6, AGG-8: members (container_id, pos, deck_key, face_url, back_url, card_id) with their new deck key and card id.

    In list order: equal (face, back) shares the key of its first card; a fingerprint seen first keeps its own key
    unless another has it, then it takes the largest key so far plus one. Members without a deck entry are left out.
    Rows are dealt by container once, to `tasks`; a fingerprint's rows follow one another, containers' fingerprints by their first
    place, and are read as they come. What is held is one container's keys, as spans of neighbouring ones, and its
    largest. `carry` names columns to keep; a column `print` is taken for the (face, back) of a card.
    """
    told = members if "print" in members.columns else members.withColumn("print", F.unhex(fingerprint("face_url", "back_url")))
    rows = told.where(F.col("deck_key").isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("c"), "pos", F.col("deck_key").cast("int").cast("bigint").alias("own"), "print", F.pmod("card_id", F.lit(100)).alias("slot"), *carry
    )
    one = Window.partitionBy("c", "print").orderBy("pos", "own")
    first = F.min("pos").over(one.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    dealt = rows.repartition(*((tasks,) if tasks else ()), "c").withColumn("first", first).withColumn("begins", F.row_number().over(one) == 1)
    dealt = dealt.sortWithinPartitions("c", "first", "print", "pos", "own")

    def allocated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        container, taken, last = None, Spans(), -1
        for batch in batches:
            begins = batch.column(0).to_numpy(zero_copy_only=False)
            at = pa.array(np.flatnonzero(begins))
            new = [last]
            for c, own in zip(batch.column(1).take(at).to_pylist(), batch.column(2).take(at).to_pylist(), strict=True):
                if container is None or c != container:
                    container, taken = c, Spans()
                last = own if taken.first_free(own) == own else taken.top + 1
                taken.add(last)
                new.append(last)
            keys = np.array(new, dtype=np.int64)[np.cumsum(begins)]
            yield pa.RecordBatch.from_arrays([*batch.columns[3:], batch.column(1), pa.array(keys)], [*batch.schema.names[3:], "c", "new_key"])

    table = dealt.select("begins", "c", "own", "pos", "slot", *carry)
    kept = StructType([*table.schema.fields[3:], table.schema["c"], StructField("new_key", LongType())])
    new = table.mapInArrow(allocated, kept)
    return new.select(F.col("c").alias(key), "pos", F.col("new_key").cast("int").alias("new_key"), numbers.joined_id(F.col("new_key"), F.col("slot")).alias("new_card_id"), *carry)


def fingerprint(*columns: str) -> Column:
    """A digest that tells nulls from empty texts, and one column from another."""
    return F.md5(F.to_json(F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)))))


class Spans:
    """A set of integers as the union of intervals; it holds as many as there are gaps between its numbers."""

    def __init__(self) -> None:
        self.begins: list[int] = []
        self.ends: list[int] = []  # of each, the first number after it

    @property
    def top(self) -> int:
        return self.ends[-1] - 1

    def first_free(self, k: int) -> int:
        """The first number from k on that isn't in the set."""
        at = bisect_right(self.begins, k) - 1
        return max(k, self.ends[at]) if at >= 0 else k

    def add(self, k: int) -> None:
        """Adds a number that isn't in the set."""
        at = bisect_right(self.begins, k)
        left, right = at > 0 and self.ends[at - 1] == k, at < len(self.begins) and self.begins[at] == k + 1
        if left and right:
            self.ends[at - 1] = self.ends.pop(at)
            del self.begins[at]
        elif left:
            self.ends[at - 1] = k + 1
        elif right:
            self.begins[at] = k
        else:
            self.begins.insert(at, k)
            self.ends.insert(at, k + 1)


def global_deck_ids(cards: DataFrame, head: int = 100_000) -> DataFrame:
    """WIN-8: cards (ord, deck_key, face_url, back_url, card_id) with `new_key` and `new_card_id`, in `ord` over all documents.
    A card whose key stays keeps its card id as it is.

    The first fingerprint of a key owns it; another takes the next integer that is free or its own. Rows are reduced to
    distinct (key, fingerprint) with their first place. A run of keys stands for itself once the fingerprints of all
    smaller keys fit below it, which running sums over the distinct keys show (one ordered window over these).

    The head of a run is read in order, its taken keys held as a union of intervals, until one interval covers all keys of the
    run. From then on every new key comes right after the last one, whatever a row asks for; so the rest needs no order but
    ranks: a row takes the smallest key that its fingerprint has from the head and that isn't below its own, else the next
    ones go to the fingerprints in the order in which they first lack one. That is joins and positions over ranges, so a
    run of any size spreads over tasks. A head is `head` rows, or four times the run's span of keys, and is read again eight
    times as long where that isn't enough.
    """
    rows = cards.withColumn("print", fingerprint("face_url", "back_url")).withColumn("id", F.col("deck_key").try_cast("bigint")).where("id is not null")
    firsts = materialise(rows.groupBy("id", "print").agg(F.min("ord").alias("first")), "fingerprints")
    per = firsts.groupBy("id").agg(F.count(F.lit(1)).alias("d"))
    before = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    up_to = Window.orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    load = per.withColumn("b", F.coalesce(F.sum("d").over(before), F.lit(0)) - F.col("id"))
    starts = load.withColumn("low", F.min("b").over(up_to)).withColumn("run", F.sum((F.col("b") == F.col("low")).cast("int")).over(up_to))
    runs = starts.groupBy("run").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.sum("d").alias("n"))
    ordered = with_positions(firsts.join(starts.select("id", "run"), "id"), "run", "first", "id", "print")
    begins = ordered.groupBy("run").agg(F.min("position").alias("at"))
    several = firsts.groupBy("print").agg((F.count(F.lit(1)) > 1).alias("several"))
    ordered = materialise(ordered.join(begins, "run").withColumn("position", F.col("position") - F.col("at")).drop("at").join(several, "print"), "ordered")
    open_, heads, scale = runs.withColumn("limit", F.greatest(F.lit(head), 4 * (F.col("hi") - F.col("lo") + 1))), [], 1
    while not open_.isEmpty():
        part = ordered.join(open_, "run").where(F.col("position") < F.col("limit") * scale)
        told = materialise(_replayed(part), "heads")
        over = told.where("id is null").select("run").unionAll(open_.where(F.col("n") <= F.col("limit") * scale).select("run")).distinct()
        heads.append(told.join(over, "run", "left_semi"))
        open_, scale = open_.join(over, "run", "left_anti"), 8 * scale
    told = reduce(DataFrame.unionAll, heads) if heads else materialise(_replayed(ordered.join(open_, "run")), "heads")
    front, ends = told.where("id is not null"), told.where("id is null").select("run", F.col("new_key").alias("top"), F.col("position").alias("until"))
    rest = ordered.join(ends, "run").where(F.col("position") > F.col("until"))
    held = front.select(F.col("run").alias("r"), F.col("print").alias("p"), F.col("new_key").alias("k"))
    own = (F.col("run") == F.col("r")) & (F.col("print") == F.col("p")) & (F.col("k") >= F.col("id"))
    rest = materialise(rest.join(held, own, "left").groupBy("run", "id", "print", "position", "top").agg(F.min("k").alias("k")), "rest")
    fresh = with_positions(rest.where("k is null").groupBy("run", "print").agg(F.min("position").alias("since"), F.min("top").alias("top")), "run", "since")
    first = fresh.groupBy("run").agg(F.min("position").alias("at"))
    given = fresh.join(first, "run").select("run", "print", (F.col("top") + F.col("position") - F.col("at")).alias("given"))
    late = rest.join(given, ["run", "print"], "left").select("id", "print", F.coalesce("k", "given").alias("new_key"))
    joined = rows.join(front.select("id", "print", "new_key").unionAll(late), ["id", "print"])
    moved = numbers.joined_id(F.col("new_key"), F.pmod("card_id", F.lit(100)))
    return joined.select("ord", "deck_key", "new_key", F.when(F.col("new_key") == F.col("id"), F.col("card_id").cast("bigint")).otherwise(moved).alias("new_card_id"))


def _replayed(part: DataFrame) -> DataFrame:
    """(run, id, print, position, new_key) of the rows of each run in order, until one interval covers its keys; then a row
    without id, whose new key is the next one and whose position is that of the last row told. Of fingerprints, only those that
    come with several keys are held."""

    def replay(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run, taken, keys, settled = None, Spans(), {}, False
        for f in frames:
            out = []
            for r, lo, hi, i, p, at, again in zip(f["run"], f["lo"], f["hi"], f["id"], f["print"], f["position"], f["several"], strict=True):
                if r != run:
                    run, taken, keys, settled = r, Spans(), {}, False
                if settled:
                    continue
                k, own = taken.first_free(i), keys.setdefault(p, []) if again else []
                place = bisect_left(own, i)
                if place < len(own) and own[place] < k:
                    k = own[place]
                else:
                    insort(own, k)
                    taken.add(k)
                out.append((r, i, p, at, k))
                if taken.first_free(lo) > hi:
                    settled = True
                    out.append((r, None, None, at, taken.first_free(lo)))
            told = pd.DataFrame(out, columns=["run", "id", "print", "position", "new_key"])
            yield told.astype({"id": "Int64"})

    dealt = part.repartition("run").sortWithinPartitions("run", "position").select("run", "lo", "hi", "id", "print", "position", "several")
    return dealt.mapInPandas(replay, "run long, id long, print string, position long, new_key long")


def rank_ids(ids: DataFrame, key: str = "id") -> DataFrame:
    """WIN-7: (id, rank), 0-based among the sorted distinct ids, as the places of a sorted manifest."""
    return sorted_manifest(ids, key).select("id", F.col("position").cast("int").alias("rank"))


def ordered_members(members: DataFrame, key: str = "container_id", item: str = "obj_id", order: str = "pos") -> DataFrame:
    """AGG-5: (key, members): the items of each container in order."""
    grouped = members.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, item))).alias("m"))
    return grouped.select(key, F.transform("m", lambda e: e[item]).alias("members"))


def sort_by_number(deck: Column) -> Column:
    """AGG-6: the entries of a deck map by the number in their key."""
    entries = F.array_sort(F.transform(F.map_entries(deck), lambda e: F.struct(e["key"].try_cast("int").alias("n"), e["key"].alias("key"), e["value"].alias("value"))))
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], e["value"])))


def sort_deck(members: DataFrame, by: str, key: str = "container_id", preserve: DataFrame | None = None, tasks: int | None = None) -> DataFrame:
    """SRT-1: members with `new_pos`, from 1: by the column descending, equal ones in their old order; containers in
    `preserve` keep their order. Rows are dealt by container to `tasks`, else to the session's shuffle partitions."""
    members = members.repartition(tasks, key) if tasks else members
    sorted_ = F.row_number().over(Window.partitionBy(key).orderBy(F.col(by).desc_nulls_last(), "pos")).cast("bigint")
    if preserve is None:
        return members.withColumn("new_pos", sorted_)
    held = preserve.select(key).distinct().withColumn("__held", F.lit(True))
    return members.join(held, key, "left").withColumn("new_pos", F.when(F.col("__held"), F.col("pos")).otherwise(sorted_)).drop("__held")


__all__ = [
    "canonical_deck_ids", "dedupe_deck_members", "first_seen", "flatten_names", "global_deck_ids", "ordered_members", "rank_ids", "sort_by_number", "sort_deck", "unique_cards", "unique_names",
]
