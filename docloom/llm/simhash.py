"""SimHash fingerprints and their near neighbours by tables of distances to pivots.

The pivots are fixed reference fingerprints. One is the base; the others fall into three families, and a family's
members differ from the base only inside its own third of the 64 bits. Every fingerprint gets its Hamming distances to
all pivots. Two fingerprints at distance 2 or less agree on all bits of at least one third, so within that family the
distances less the distance to the base are equal: these differences are the key under which candidates meet. Of the
candidates those whose distances to any pivot differ by over 2 are discarded; the rest are verified bit by bit.

In groups of many fingerprints under one key, pairs are not formed. There every member goes to each point that is
within one bit outside the shared third: two members are at distance 2 or less if and only if they meet in a point,
and no point can hold more than 65 fingerprints, so the work stays in proportion to the members.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.checkpoints import materialise
from docloom.llm.common import longs, map_batches, read, utf8
from docloom.operators.graph import connected_components

MAX_BITS = 2
#: Bits of the three families: all 64, in shares that differ by one at most.
THIRDS = ((0, 21), (21, 43), (43, 64))
PIVOTS_PER_FAMILY = 12
#: Members of a key up to which pairs are formed; beyond it they meet in points.
PAIRED = 64


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivots(seed: int = 7) -> tuple[int, list[list[int]]]:
    """The base and the members of each family, as unsigned integers."""
    rnd = random.Random(seed)
    base = rnd.getrandbits(64)
    return base, [[base ^ (rnd.getrandbits(b - a) << a) for _ in range(PIVOTS_PER_FAMILY)] for a, b in THIRDS]


def fingerprints(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(columns of `keep`, fp): the 64-bit SimHash of each whole text, as a signed long.

    A-Z lowered, words between ASCII white space, shingles of `shingle` words joined by spaces, repeats included;
    a text of fewer words is one shingle, one without words has fingerprint 0. A bit is set if it is in over half
    of the shingles' XXH64 (seed 42).
    """
    keep = keep if keep is not None else [doc_id]
    schema = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in keep)

    def fingerprint(data: bytes) -> int:
        words = data.lower().split()
        if not words:
            return 0
        if len(words) < shingle:
            hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
        else:
            joined = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
            hashes = np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in joined), np.uint64, len(words) - shingle + 1)
        ones = np.zeros(64, np.int64)
        for i in range(0, len(hashes), 255):  # as many as a byte can count
            ones += np.unpackbits(hashes[i : i + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint8)
        return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        found = longs([fingerprint(x) for x in utf8(b.column(len(keep)))])
        return pa.RecordBatch.from_arrays([*b.columns[: len(keep)], found], [*keep, "fp"])

    return map_batches(docs.select(*(F.col(f"`{c}`") for c in keep), F.col(text)).toDF(*(f"c{i}" for i in range(len(keep) + 1))), each, f"{schema}fp long")


def _distance(x: Column, pivot: int) -> Column:
    return F.bit_count(x.bitwiseXOR(F.lit(_signed(pivot)))).cast("byte")


def pivot_table(distinct: DataFrame) -> DataFrame:
    """(fp, family, key, dists): a row for each family; dists are the distances to all pivots, the base first."""
    base, families = pivots()
    x = F.col("fp")
    dists = F.array(_distance(x, base), *(_distance(x, p) for f in families for p in f))
    table = distinct.select("fp", dists.alias("dists"))
    keys = []
    for i in range(len(families)):
        parts = [(F.col("dists")[1 + i * PIVOTS_PER_FAMILY + j] - F.col("dists")[0]) for j in range(PIVOTS_PER_FAMILY)]
        keys.append(F.struct(F.lit(i).alias("family"), F.concat_ws(",", *(p.cast("string") for p in parts)).alias("key")))
    return table.withColumn("k", F.explode(F.array(*keys))).select("fp", "k.family", "k.key", "dists")


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): links between different fingerprints, enough of them that whatever is reachable stays reachable."""
    table = materialise(pivot_table(distinct), "pivots")
    sizes = table.groupBy("family", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = materialise(table.join(sizes, ["family", "key"]), "candidates")
    few, many = met.where(F.col("members") <= PAIRED), met.where(F.col("members") > PAIRED)

    a = few.select("family", "key", F.col("fp").alias("a"), F.col("dists").alias("da"))
    b = few.select("family", "key", F.col("fp").alias("b"), F.col("dists").alias("db"))
    near = F.forall(F.zip_with("da", "db", lambda x, y: F.abs(x - y)), lambda d: d <= MAX_BITS)
    pairs = a.join(b, ["family", "key"]).where(F.col("a") < F.col("b")).where(near)
    pairs = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS).select("a", "b")

    flips = F.lit(None)
    for i, (lo, hi) in enumerate(THIRDS):
        outside = [_signed(1 << k) for k in range(64) if not lo <= k < hi]
        flips = F.when(F.col("family") == i, F.array(F.lit(0).cast("long"), *(F.lit(m) for m in outside))).otherwise(flips)
    points = many.select("family", "key", "fp", F.explode(flips).alias("flip")).withColumn("point", F.col("fp").bitwiseXOR(F.col("flip")))
    met_in = points.groupBy("family", "point").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    stars = met_in.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a < b")
    return pairs.unionAll(stars).distinct()


def near_duplicate_groups(docs: DataFrame, shingle: int = 3, doc_id: str = "doc_id", text: str = "text", prints: DataFrame | None = None) -> DataFrame:
    """Per row: doc_id, fp, component_id (the smallest doc_id reachable over links of 2 bits or less).

    Copies are first reduced to one row per fingerprint, so a group of any size costs one row; null ids are
    passed through and never name a group unless all its ids are null. A null text is empty: fingerprint 0,
    linked like any other. Repeated rows get a row each; other columns are ignored; an empty table gives an empty
    result.
    """
    prints = prints if prints is not None else materialise(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), shingle), "prints")
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    groups = connected_components(materialise(links(distinct.select("fp")), "links"), "a", "b")
    rooted = distinct.join(groups, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("component", "fp"))
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicate_groups(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
