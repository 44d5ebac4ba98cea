"""Outputs: what to write, delete and rename, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.checkpoints import materialise
from docloom.functions import paths

#: Fixed values of the file format.
SIDECARS = (".json", ".gmnotes", ".ttslua", ".luascriptstate")


def changed_only(docs: DataFrame, before: Column, after: Column, raw: str | None = None) -> DataFrame:
    r"""SNK-1: rows whose value changed, or whose raw text holds a \u escape. Narrow: old and new stand in one row."""
    changed = ~before.eqNullSafe(after)
    return docs.where(changed | F.coalesce(F.contains(F.col(raw), F.lit("\\u")), F.lit(False)) if raw else changed)


def write_documents(df: DataFrame, at: str, partition_by: Sequence[str] = (), kind: str = "parquet") -> None:
    """SNK-2 and SNK-6: one document, or flat record, per row."""
    df.write.partitionBy(*partition_by).format(kind).save(at)


def delete_manifest(files: DataFrame, doomed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SNK-3: (survivors, manifest) of `files` by `path`: doomed paths go, and so do the sidecars of the same folder
    and stem that exist. Shuffles by path."""
    base = F.regexp_replace("path", r"\.[^./]*$", "")
    gone = doomed.select(F.explode(F.array("path", *(F.concat(base, F.lit(s)) for s in SIDECARS))).alias("path")).distinct()
    return files.join(gone, "path", "left_anti"), files.join(gone, "path", "left_semi").select("path")


def rename_manifest(objects: DataFrame, old_path: str, new_name: Column) -> DataFrame:
    """SNK-4: (old_path, new_path) of the rows whose file name changes."""
    folder = paths.directory(F.col(old_path))
    new = F.when(folder == "", new_name).otherwise(F.concat(folder, F.lit("/"), new_name))
    return objects.select(F.col(old_path).alias("old_path"), new.alias("new_path")).where("old_path <> new_path")


def group_table(groups: DataFrame) -> DataFrame:
    """SNK-5: (id, line) with a line per id that lists its sorted siblings, ordered by id."""
    shown = F.concat_ws(", ", F.transform(F.sort_array("siblings"), lambda x: F.concat(F.lit('"'), x, F.lit('"'))))
    return groups.select("id", F.concat(F.lit('["'), F.col("id"), F.lit('"] = { '), shown, F.lit(" },")).alias("line")).orderBy("id")


def run_report(df: DataFrame, **counters: Column) -> DataFrame:
    """SNK-7 and AGG-1: one row: scanned, and for each name the number of rows for which the condition holds."""
    return df.agg(F.count(F.lit(1)).alias("scanned"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in counters.items()))


def skipped_ids(df: DataFrame, key: str) -> DataFrame:
    """AGG-2: one row: the sorted distinct keys, and their number; for reports of a bounded size (else `sorted_manifest`)."""
    return df.agg(F.sort_array(F.collect_set(key)).alias("ids"), F.countDistinct(key).alias("n_ids"))


def with_positions(df: DataFrame, *order: str) -> DataFrame:
    """The rows, written once, with their `position` in an order, 0-based: dealt by ranges and sorted within them; a row's
    place in its file and the number of rows in the files before make it. What is gathered is a row a file."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__m", F.monotonically_increasing_id())
    written = materialise(ranged, "positions").withColumn("__part", F.shiftright("__m", 33)).withColumn("__place", F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))).drop("__m")
    sizes = written.groupBy("__part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("__part", before.alias("__offset")))  # a row per shuffle partition at most
    return written.join(offsets, "__part").withColumn("position", F.col("__offset") + F.col("__place")).drop("__part", "__place", "__offset")


def sorted_manifest(df: DataFrame, key: str) -> DataFrame:
    """AGG-2 at any size: (id, position) of the sorted distinct keys, 0-based; null keys are left out."""
    return with_positions(df.select(F.col(key).alias("id")).where("id is not null").distinct(), "id")
