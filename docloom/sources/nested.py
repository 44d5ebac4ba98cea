"""Nested documents as tables of their parts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.checkpoints import materialise
from docloom.functions.nesting import nested_objects

#: Bytes of objects handed to Spark at once, about.
ROWS_BYTES = 4 << 20
CONTAINER = r"^(OBJECT|ARRAY)"


def _children(level: DataFrame, value: str) -> DataFrame:
    return level.lateralJoin(level.sparkSession.tvf.variant_explode(F.col(value).outer()))


def nested_sets(docs: DataFrame, key: str, text: str, root: str = "ObjectStates", children: str = "ContainedObjects", paths: bool = False) -> DataFrame:
    """SRC-5, GRF-2, JOIN-13: (key, enter, leave, depth, parent, place, object) of every object nested in a saved document.

    `enter` numbers a document's objects in pre-order from 1, `leave` is the largest number within an object, so what lies
    in it at any depth is an interval (`lies_in`); `parent` is the number of the object right around it, 0 for roots. `object`
    is its own text, the lists of its objects empty, so a document's rows are as long as its text together. With `paths` also
    `ord_path`, the places from the root on. Roots as in `flatten_objects`. Narrow: one pass over each text, at any depth;
    a document that doesn't parse has no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    names = ["key", "enter", "leave", "depth", "parent", "place", "object", "ord_path"]
    shape = "key " + kind + ", enter long, leave long, depth int, parent long, place int, object string, ord_path array<int>"

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, small = pa.int64(), pa.int32()
        for batch in batches:
            kinds = [batch.schema.field(0).type, whole, whole, small, whole, small, batch.schema.field(1).type, pa.list_(small)]

            def shown(n: int, rows: list[tuple], batch: pa.RecordBatch = batch, kinds: list[pa.DataType] = kinds) -> pa.RecordBatch:
                own = pa.array(rows, pa.struct([(str(i), t) for i, t in enumerate(kinds[1:])]))
                return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([n] * len(rows), small)), *own.flatten()], names)

            for n, t in enumerate(batch.column(1)):
                at: list[int] = []
                rows, size = [], 0
                for enter, leave, depth, parent, place, own in nested_objects(t.as_py(), root, children):
                    if paths:
                        del at[depth:]
                        at.append(place)
                    rows.append((enter, leave, depth, parent, place, own, list(at) if paths else None))
                    size += 64 + len(own) + 8 * depth * paths
                    if size > ROWS_BYTES:
                        yield shown(n, rows)
                        rows, size = [], 0
                if rows:
                    yield shown(n, rows)

    found = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null").mapInArrow(flat, shape)
    found = found if paths else found.drop("ord_path")
    return found.withColumnRenamed("key", key)


def lies_in(inner: str, outer: str) -> Column:
    """Whether the object of one alias lies in that of another, at any depth, of one document."""
    return (F.col(f"{outer}.enter") < F.col(f"{inner}.enter")) & (F.col(f"{inner}.enter") <= F.col(f"{outer}.leave"))


def flatten_objects(docs: DataFrame, key: str, text: str, root: str = "ObjectStates", children: str = "ContainedObjects") -> DataFrame:
    """SRC-5: (key, ord_path, depth, object) of every object nested in a saved document, as a variant, the lists of its own
    objects empty.

    Roots are the objects of `root`, else of a top-level list or `children`, else the object itself. `ord_path` holds the
    0-based positions, so ordering by it is pre-order. Narrow; documents that don't parse have no rows.
    """
    return nested_sets(docs, key, text, root, children, paths=True).select(key, "ord_path", "depth", F.try_parse_json("object").alias("object"))


def json_leaves(docs: DataFrame, key: str, text: str, max_depth: int = 64) -> DataFrame:
    """(key, path, value, kind): a row for each scalar, null, and empty container; `path` is an array of keys and
    0-based positions written as [i]; `key` must have another name than these. Keys of objects come in alphabetical
    order, list elements in place. Levels are written down, so none is worked out twice."""
    level = docs.select(F.col(key), F.array().cast("array<string>").alias("path"), F.try_parse_json(F.col(text)).alias("v"))
    level = materialise(level, "level").where("v is not null")  # a filter ahead of the table would work the texts out twice
    found = None
    for _ in range(max_depth):
        level = level.withColumn("kind", F.schema_of_variant("v"))
        nested = F.col("kind").rlike(CONTAINER) & ~F.col("kind").isin("OBJECT<>", "ARRAY<VOID>")
        flat = level.where(~nested).select(key, "path", F.try_variant_get("v", "$", "string").alias("value"), "kind")
        empty = F.when(F.col("kind") == "OBJECT<>", "{}").when(F.col("kind") == "ARRAY<VOID>", F.coalesce("value", F.lit("[]"))).otherwise(F.col("value"))
        flat = flat.withColumn("value", empty)
        found = flat if found is None else found.unionAll(flat)
        rest = level.where(nested).drop("kind")
        rest = rest if found is flat else materialise(rest, "level")  # the documents themselves are written already
        if rest.isEmpty():
            return found
        step = F.coalesce(F.col("key_"), F.concat(F.lit("["), F.col("pos"), F.lit("]")))
        tvf = docs.sparkSession.tvf.variant_explode(F.col("v").outer()).withColumnRenamed("key", "key_")
        level = rest.lateralJoin(tvf).select(key, F.concat("path", F.array(step)).alias("path"), F.col("value").alias("v"))
    raise ValueError(f"documents nest deeper than {max_depth}")


def descendants(edges: DataFrame, parent: str, child: str) -> DataFrame:
    """GRF-2: (ancestor, descendant, depth) of a containment tree at any depth. Each round joins the pairs as far apart as any
    yet with all pairs, which doubles how far they reach, and is written down. Cycles end in an error."""
    step = edges.select(F.col(parent).alias("p"), F.col(child).alias("c")).where("p is not null and c is not null").distinct()
    found = materialise(step.select(F.col("p").alias("ancestor"), F.col("c").alias("descendant"), F.lit(1).alias("depth")), "closure")
    reach = 1
    while True:
        on = found.select(F.col("ancestor").alias("mid"), F.col("descendant").alias("end"), F.col("depth").alias("more"))
        far = found.where(F.col("depth") == reach).join(on, F.col("descendant") == F.col("mid"))
        far = materialise(far.select("ancestor", F.col("end").alias("descendant"), (F.col("depth") + F.col("more")).alias("depth")), "closure")
        if far.isEmpty():
            return found
        if not far.where(F.col("ancestor") == F.col("descendant")).isEmpty():
            raise ValueError("the containment has a cycle")
        found, reach = found.unionAll(far), 2 * reach


def records_from(docs: DataFrame, key: str, text: str, fields: Sequence[str]) -> DataFrame:
    """SRC-12: (key, pos, fields) of a document's records: elements of a top-level list; of a top-level object the
    values, lists among them spliced, other values than objects left out. Missing fields are null."""
    parsed = docs.select(key, F.try_parse_json(F.col(text)).alias("v")).where("v is not null")
    top = _children(parsed, "v").select(key, F.col("pos").alias("top"), F.col("key").alias("k") if key != "key" else F.lit(None), F.col("value").alias("o"))
    kind = F.schema_of_variant("o")
    whole = top.where(kind.startswith("OBJECT")).select(key, "top", F.lit(0).alias("sub"), "o")
    lists = top.where(kind.startswith("ARRAY") & F.col("k").isNotNull())
    tvf = docs.sparkSession.tvf.variant_explode(F.col("o").outer()).toDF("sub", "k2", "o2")
    spliced = lists.lateralJoin(tvf).where(F.schema_of_variant("o2").startswith("OBJECT")).select(key, "top", "sub", F.col("o2").alias("o"))
    return whole.unionAll(spliced).select(key, "top", "sub", *(F.try_variant_get("o", f"$.{f}", "string").alias(f) for f in fields))
