"""Near-duplicate removal by wide SimHash fingerprints and pivot distance tables.

For similar, not nearly equal, texts 64 bits say too little: at a Jaccard similarity of 0.8 some ten of them differ.
Here a fingerprint has 512 bits, from eight independent 64-bit hashes of each shingle. A family of pivots are reference
fingerprints that differ from a base only in twenty or more bits, chosen from all; a text's coordinates in the family are its distances
to the members less the distance to the base. Pairs whose coordinates are equal in at least one of some 100 families
(more for more texts, so that as many pairs meet) are candidates, all others are discarded. From all bits and the numbers of shingles the similarity is estimated; pairs whose
estimate isn't far below the limit are verified on the shingles of both texts.

Texts that meet in a family form a run. It is first searched by growing groups: a text is compared with those of the run
that no group has yet, and the ones it reaches join its group. Each text keeps its nearest such link, so thousands of copies of
one text make thousands of links, not millions of pairs. Then, within runs whose texts verified links don't connect, the
pairs of different groups are verified in place, each pair in the first family in which it meets.

Of texts of few shingles, whose bits often tie, similar ones are found exactly: they meet in the set of shingles that they share.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docloom.checkpoints import materialise
from docloom.llm.common import batch, longs, map_batches, plain_names, utf8
from docloom.operators.graph import connected_components

SHINGLE, SIMILARITY = 5, 0.8
#: Allowance of the test of 512 bits for their noise (standard deviation 0.03 at 0.8); what passes is verified exactly.
NOISE = 0.1
#: Margin from which on an estimate makes a first link within a run.
SURE = 0.04
HASHES, MEMBERS = 8, 16
#: Bits of a family at least; each doubling of the texts beyond 2**16 adds one, so that chance meetings don't grow.
FAMILY_BITS = 20
#: Share of pairs at the limit of similarity that meet in some family and pass the test of all bits, for any number of texts.
RECALL = 0.92
#: Shared shingles up to which pairs are found by the shared set itself, whatever their bits.
SHORT = 8
#: Families whose keys are made at once.
AT_ONCE = 16


def expected_recall(bits: int, families: int, similarity: float = SIMILARITY, least: float = SIMILARITY - NOISE) -> float:
    """Share of pairs of this similarity that meet and whose estimate is `least` or more. A pair's differing bits are
    binomial; given their number, families meet independently, for each draws its bits from all."""
    size = 64 * HASHES
    apart = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    differ = np.arange(size + 1)
    log_choose = np.array([math.lgamma(size + 1) - math.lgamma(d + 1) - math.lgamma(size - d + 1) for d in differ])
    chance = np.exp(log_choose + differ * np.log(apart) + (size - differ) * np.log1p(-apart))
    drawn = np.arange(bits)
    agree = np.prod(np.clip(size - differ[:, None] - drawn, 0, None) / (size - drawn), axis=1)
    cosine = np.cos(np.pi * differ / size)
    return float(np.sum(chance * (1 - (1 - agree) ** families) * (cosine >= 2 * least / (1 + least))))


def family_plan(texts: int, similarity: float = SIMILARITY) -> tuple[int, int]:
    """(bits, families) for so many texts, families enough for RECALL (or as near as the test of all bits lets it come)."""
    bits = min(max(FAMILY_BITS, int(np.ceil(np.log2(max(texts, 2)))) + 4), 48)
    least = similarity - NOISE
    want = min(RECALL, 0.99 * expected_recall(0, 1, similarity, least))
    low, high = 1, 2
    while expected_recall(bits, high, similarity, least) < want:
        low, high = high, 2 * high
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if expected_recall(bits, middle, similarity, least) >= want else (middle + 1, high)
    return bits, high


def _families(bits: int, families: int, seed: int = 11) -> tuple[np.ndarray, list[tuple[list[int], np.ndarray]]]:
    """The base, and for each family the bits of all 512 that it looks at and which of them each member flips."""
    rnd = random.Random(seed)
    base = np.array([rnd.getrandbits(64) for _ in range(HASHES)], np.uint64)
    found = []
    for _ in range(families):
        chosen = rnd.sample(range(64 * HASHES), bits)
        found.append((chosen, np.array([[rnd.random() < 0.5 for _ in range(MEMBERS)] for _ in chosen], np.float32)))
    return base, found


def family_masks(bits: int, families: int) -> np.ndarray:
    """The bits that each family looks at, as words: two texts meet in it if they differ in none of them."""
    masks = np.zeros((families, 64 * HASHES), np.uint8)
    for mask, (chosen, _) in zip(masks, _families(bits, families)[1], strict=True):
        mask[chosen] = 1
    return np.packbits(masks, axis=1, bitorder="little").view("<u8")


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """Distinct hashes of the text's word shingles; of all its words, if they are fewer than `k`."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    joined = map(b" ".join, zip(*(words[i:] for i in range(k))))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, joined), np.uint64, len(words) - k + 1))


def wide_fingerprint(hashes: np.ndarray) -> bytes:
    """Bit i of word j is 1 if it is in over half of the shingles' j-th hashes."""
    n, ones = len(hashes), np.zeros(64 * HASHES, np.int64)
    salts = np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(0, n, 255):  # as many as a byte can count
        h = (hashes[i : i + 255, None] ^ salts) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
        ones += np.unpackbits(h.view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.uint8)
    return np.packbits(2 * ones > n, bitorder="little").tobytes()


def shared_sizes(n: int, similarity: float) -> range:
    """Sizes up to SHORT of what a set of n may share with one as similar; none if only equal sets are."""
    least, most = math.ceil(similarity * n - 1e-9), math.floor(n / similarity + 1e-9)
    return range(least, min(n, SHORT) + 1) if least < n or most > n else range(0)


def prints(docs: DataFrame, doc_id: str, text: str, shingle: int, similarity: float) -> DataFrame:
    """(doc_id, digest, fp, n, few): fingerprint and number of distinct shingles of each whole text, and the shingles
    themselves if they are few."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col("__digest").alias("digest"), F.col(text).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [(wide_fingerprint(h), len(h), h.tobytes() if shared_sizes(len(h), similarity) else None) for h in (shingle_hashes(x, shingle) for x in utf8(b.column("text")))]
        fp, n, few = zip(*found, strict=True) if found else ((), (), ())
        return batch(doc_id=b.column("doc_id"), digest=b.column("digest"), fp=pa.array(fp, pa.binary()), n=longs(n), few=pa.array(few, pa.binary()))

    return map_batches(source, each, f"doc_id {kind}, digest string, fp binary, n long, few binary")


def short_links(distinct: DataFrame, similarity: float) -> DataFrame:
    """(a, b): enough links to connect all pairs of this similarity that share SHORT shingles at most.

    A set goes to each of its subsets that a similar set may share with it; two similar sets meet in what they share. There all
    are linked with the smallest set, which is as similar to each as any other of them is, at least. A set of ten gives 45 rows,
    smaller ones fewer; a subset that many hold is a partial minimum and a join.
    """

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        ids, sizes, shared, keys = [], [], [], []
        for i, data in zip(b.column("id").to_pylist(), b.column("few").to_pylist(), strict=True):
            own = [data[k : k + 8] for k in range(0, len(data), 8)]  # in the order of the hashes
            for size in shared_sizes(len(own), similarity):
                for subset in combinations(own, size):
                    ids.append(i)
                    sizes.append(len(own))
                    shared.append(size)
                    keys.append(xxhash.xxh3_128_digest(b"".join(subset)))
        return batch(id=longs(ids), n=longs(sizes), shared=longs(shared), subset=pa.array(keys, pa.binary()))

    met = materialise(map_batches(distinct.where("few is not null").select("id", "few"), each, "id long, n long, shared long, subset binary"), "subsets")
    smallest = met.groupBy("subset").agg(F.min(F.struct("n", "id")).alias("x"), F.count(F.lit(1)).alias("sets")).where("sets > 1")
    pairs = met.join(smallest.select("subset", F.col("x.n").alias("m"), F.col("x.id").alias("other")), "subset").where("id <> other")
    pairs = pairs.where(F.col("shared") + 1e-9 >= similarity * (F.col("n") + F.col("m") - F.col("shared")))
    return pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def coordinates(distinct: DataFrame, bits: int, count: int) -> DataFrame:
    """(family, key, id): a row for each family; the key is a hash of the coordinates, a byte each."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, families = _families(bits, count)
        for b in batches:
            if not b.num_rows:
                continue
            ids, fps = b.column("id").to_numpy(), _fps(b.column("fp"))
            # a flipped bit is one step farther than the base where the text agrees with the base, one nearer where not
            steps = 1 - 2 * np.unpackbits((fps ^ base).view(np.uint8), axis=1, bitorder="little").astype(np.float32)
            for start in range(0, count, AT_ONCE):
                keys = []
                for chosen, flipped in families[start : start + AT_ONCE]:
                    packed = np.ascontiguousarray((steps[:, chosen] @ flipped).astype(np.int8)).view(np.uint64)
                    keys.append((packed[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ packed[:, 1]).view(np.int64))
                family = np.repeat(np.arange(start, start + len(keys), dtype=np.int32), len(ids))
                yield batch(family=pa.array(family), key=longs(np.concatenate(keys)), id=longs(np.tile(ids, len(keys))))

    return distinct.select("id", "fp").mapInArrow(each, "family int, key long, id long")


def similar(fps: np.ndarray, n: np.ndarray, fp: np.ndarray, size: np.ndarray | float, least: float) -> np.ndarray:
    """Whether the estimated Jaccard similarity of each fingerprint (of n shingles) to its other one is `least` or more."""
    cosine = np.cos(np.pi * np.bitwise_count(fps ^ fp).sum(1, dtype=np.int64) / (64 * HASHES))
    shared = cosine * np.sqrt(n * size)
    return (shared >= least * (n + size - shared)) & (np.minimum(n, size) >= SIMILARITY * np.maximum(n, size))


def run_links(ids: np.ndarray, fps: np.ndarray, n: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, int]]:
    """(texts, the text that reached them): a run is searched by growing groups, so each text is reached once at most."""
    left = np.arange(len(ids))
    while len(left) > 1:
        group, left = [left[0]], left[1:]
        while group and len(left):
            x = group.pop()
            near = similar(fps[left], n[left], fps[x], n[x], least)
            if near.any():
                reached = left[near]
                yield reached, x
                group += reached.tolist()
                left = left[~near]


def _fps(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, HASHES)


def _whole_runs(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[int, int, list]]:
    """(family, key, the columns' values) of each run, from rows sorted by family and key; fingerprints as words, sets as
    lists of bytes."""

    def values(b: pa.RecordBatch, c: str):
        if c == "hashes":
            return np.array(b.column(c).to_pylist(), object)
        return _fps(b.column(c)) if c == "fp" else b.column(c).to_numpy()

    held = None
    for b in batches:
        if not b.num_rows:
            continue
        own = [values(b, c) for c in ("family", "key", *columns)]
        rows = own if held is None else [np.concatenate(x) for x in zip(held, own, strict=True)]
        new = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1
        for i, j in zip([0, *new[:-1]], new, strict=False):
            yield int(rows[0][i]), int(rows[1][i]), [x[i:j] for x in rows[2:]]
        last = int(new[-1]) if len(new) else 0  # the last run may go on in the next batch
        held = [x[last:] for x in rows]
    if held is not None:
        yield int(held[0][0]), int(held[1][0]), held[2:]


def _by_run(runs: DataFrame, *columns: str) -> DataFrame:
    return runs.repartition("family", "key").sortWithinPartitions("family", "key", "id").select("family", "key", *columns)


def with_prints(runs: DataFrame, distinct: DataFrame) -> DataFrame:
    return runs.join(distinct.select("id", "fp", F.col("n").cast("double").alias("n")), "id")


def meetings(distinct: DataFrame, bits: int, families: int) -> DataFrame:
    """(family, key, id): texts that meet others."""
    met = F.count(F.lit(1)).over(Window.partitionBy("family", "key"))
    return coordinates(distinct, bits, families).withColumn("met", met).where("met > 1").drop("met")


def first_links(runs: DataFrame, distinct: DataFrame, sure: float) -> DataFrame:
    """(a, b), a < b: for each text, of those that reach it in some run by an estimate of `sure` or more, the nearest."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, (ids, fps, n) in _whole_runs(batches, "id", "fp", "n"):
            for reached, x in run_links(ids, fps, n, sure):
                apart = np.bitwise_count(fps[reached] ^ fps[x]).sum(1, dtype=np.int64)
                yield batch(id=longs(ids[reached]), apart=longs(apart), other=longs(np.full(len(reached), ids[x])))

    found = _by_run(with_prints(runs, distinct), "id", "fp", "n").mapInArrow(search, "id long, apart long, other long")
    nearest = found.groupBy("id").agg(F.min(F.struct("apart", "other")).alias("x")).select("id", F.col("x.other").alias("other"))
    return nearest.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def _open_pairs(family: int, root: np.ndarray, fps: np.ndarray, n: np.ndarray, least: float, earlier: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(text, partners): pairs of different roots that pass the test of all bits and met in no earlier family."""
    for x in range(len(root) - 1):
        other = x + 1 + np.flatnonzero(root[x + 1 :] != root[x])
        other = other[similar(fps[other], n[other], fps[x], n[x], least)]
        for mask in earlier[:family]:
            if not len(other):
                break
            other = other[((fps[other] ^ fps[x]) & mask).any(1)]
        if len(other):
            yield x, other


def open_texts(rooted: DataFrame, bits: int, families: int, least: float) -> DataFrame:
    """(family, key, id): the texts of a run that have a partner to be verified in it."""
    masks = family_masks(bits, families)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for family, key, (root, ids, fps, n) in _whole_runs(batches, "root", "id", "fp", "n"):
            some = np.zeros(len(ids), bool)
            if (root != root[0]).any():
                for x, other in _open_pairs(family, root, fps, n, least, masks):
                    some[x] = some[other] = True
            if some.any():
                yield batch(family=pa.array(np.full(some.sum(), family, np.int32)), key=longs(np.full(some.sum(), key)), id=longs(ids[some]))

    return _by_run(rooted, "root", "id", "fp", "n").mapInArrow(search, "family int, key long, id long")


def same_enough(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two sets of hashes have a Jaccard similarity of `similarity` or more."""
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared + 1e-9 >= similarity * (len(x) + len(y) - shared)


def open_links(rooted: DataFrame, bits: int, families: int, least: float, similarity: float) -> DataFrame:
    """(a, b): roots that links connect, verified on the sets in `hashes`; of a run as many as connect what its pairs connect."""
    masks = family_masks(bits, families)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for family, _, (root, ids, fps, n, sets) in _whole_runs(batches, "root", "id", "fp", "n", "hashes"):
            sets = [np.frombuffer(x, np.uint64) for x in sets]
            now = root.copy()
            for x, other in _open_pairs(family, root, fps, n, least, masks):
                for y in other:
                    if now[x] != now[y] and same_enough(sets[x], sets[y], similarity):
                        now[now == now[y]] = now[x]
                        yield batch(a=longs([min(root[x], root[y])]), b=longs([max(root[x], root[y])]))

    return _by_run(rooted, "root", "id", "fp", "n", "hashes").mapInArrow(search, "a long, b long")


def shingle_sets(tagged: DataFrame, wanted: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """(id, hashes): the distinct shingle hashes, eight bytes each, of a text of each fingerprint in `wanted`."""
    source = tagged.select(F.col(doc_id).alias("d"), F.col("__digest").alias("u"), F.col(text).alias("text"))
    named = wanted.select("id", F.col("best.doc_id").alias("e"), F.col("best.digest").alias("v"))

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        return batch(id=b.column("id"), hashes=pa.array([shingle_hashes(x, shingle).tobytes() for x in utf8(b.column("text"))], pa.binary()))

    texts = source.join(named, F.col("d").eqNullSafe(F.col("e")) & (F.col("u") == F.col("v"))).select("id", "text")
    return map_batches(texts, each, "id long, hashes binary").dropDuplicates(["id"])


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets have a Jaccard similarity of `similarity` or more."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        sides = ([np.frombuffer(x.as_buffer(), np.uint64) for x in b.column(c)] for c in ("x", "y"))
        passed = [same_enough(x, y, similarity) for x, y in zip(*sides, strict=True)]
        return b.select(["a", "b"]).filter(pa.array(passed, pa.bool_()))

    x, y = (sets.select(F.col("id").alias(end), F.col("hashes").alias(name)) for end, name in (("a", "x"), ("b", "y")))
    return map_batches(pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "x", "y"), each, "a long, b long")


def with_roots(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """Rows (id) with their `root`: the component of the id, else itself."""
    return rows.join(linked, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("component", "id")).drop("node", "component")


def near_roots(tagged: DataFrame, distinct: DataFrame, doc_id: str, text: str, shingle: int, similarity: float) -> DataFrame:
    """`distinct` with the `root` of each id: what verified links connect has one. They connect whatever all pairs that
    meet, pass the test of all bits and are verified connect.

    First every text is verified against one other, the nearest that reaches it. Where texts of a run are still in different
    groups, all pairs of different groups that pass the test of all bits are verified within the run, to which only the
    texts of such pairs bring their shingles; a pair belongs to the first family in which it meets. What those connect are
    the roots of the first groups, so the second search for components sees those links alone. Links of texts of few
    shingles, which need no verification, are among the first.
    """
    short = short_links(distinct, similarity)
    distinct = distinct.drop("few")
    least = similarity - NOISE
    bits, families = family_plan(distinct.count())
    runs = materialise(meetings(distinct, bits, families), "runs")
    first = materialise(first_links(runs, distinct, similarity + SURE), "candidates")
    ends = first.select(F.col("a").alias("id")).unionAll(first.select(F.col("b").alias("id"))).distinct()
    sets = materialise(shingle_sets(tagged, distinct.join(ends, "id", "left_semi"), doc_id, text, shingle), "shingles")
    linked = connected_components(verified(first, sets, similarity).unionAll(short), "a", "b")
    rooted = materialise(with_roots(distinct, linked), "roots")
    prints = rooted.select("id", "fp", F.col("n").cast("double").alias("n"), "root")
    left = materialise(open_texts(runs.join(prints, "id"), bits, families, least), "open")
    more = left.select("id").distinct().join(sets, "id", "left_anti")
    sets = sets.unionAll(materialise(shingle_sets(tagged, distinct.join(more, "id", "left_semi"), doc_id, text, shingle), "shingles"))
    joined = connected_components(open_links(left.join(prints, "id").join(sets, "id"), bits, families, least, similarity), "a", "b")
    return rooted.join(joined, F.col("root") == F.col("node"), "left").withColumn("root", F.coalesce("component", "root")).drop("node", "component")


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of `docs` of which one stays for each group of near-duplicates: that with the smallest id (null
    last, then by the text's digest). Columns as in `docs`.

    Texts are near-duplicates if the Jaccard similarity of their sets of `shingle`-word shingles is `similarity` or
    more, verified on the sets; pairs are found with a recall of RECALL at the limit, all of them if they share SHORT shingles
    at most. Groups are what links reach. Texts whose
    512 bits and numbers of shingles are equal count as equal. Texts of fewer words are one shingle; null and
    empty texts are alike and one of them stays. Rows equal in id and text are one document; other columns don't
    matter; an empty table gives an empty one. Equal fingerprints are reduced to one row first, so copies by the
    thousand cost one row.
    """
    plain, (doc_id, text) = plain_names(docs, doc_id, text)
    tagged = plain.withColumn("__digest", F.md5(F.coalesce(F.col(text), F.lit(""))))
    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id"), F.col("digest"))
    groups = prints(tagged, doc_id, text, shingle, similarity).groupBy("fp", "n").agg(F.min(order).alias("best"), F.min("few").alias("few"))
    distinct = materialise(groups.withColumn("id", F.xxhash64("fp", "n")), "fingerprints")
    rooted = near_roots(tagged, distinct, doc_id, text, shingle, similarity)
    stay = rooted.groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.doc_id").alias("__d"), F.col("best.digest").alias("__u"))
    same = F.col(doc_id).eqNullSafe(F.col("__d")) & (F.col("__digest") == F.col("__u"))
    return tagged.join(stay, same, "left_semi").dropDuplicates([doc_id, "__digest"]).select(*plain.columns).toDF(*docs.columns)
