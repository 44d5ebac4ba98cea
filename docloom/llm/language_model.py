"""Language-model scoring with a hierarchical Pitman-Yor model, seated by Gibbs sampling.

Every word is a customer of the restaurant of its context, the hashed word before it; all context restaurants share one
parent, the restaurant of single words, whose base is uniform over the vocabulary and one unknown word. A restaurant's
seating is kept as customers and tables per dish; a Gibbs step draws a dish's tables from their distribution given all
other dishes (generalised Stirling numbers sum over who sits where), and each table of a context restaurant is a
customer of the parent. Predictive probabilities are averaged over the samples after burn-in.

Data flow: documents are packed in batches and cut into buckets by ranges of the word's hash. A bucket has all of a word
there is to know, so word counts, seatings and the parent's dishes are local to it. What buckets must share is the
customers and tables of each context restaurant: two vectors of a fixed length, summed over buckets after each sweep.
Frequent words, which a first pass finds, are dealt out over all buckets by their context, and their sums are shared too.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.checkpoints import materialise
from docloom.llm.common import batch, longs, map_batches, read, utf8

CONTEXT_BITS = 14
CONTEXTS = 1 << CONTEXT_BITS
#: Documents of a batch, and words at which a batch is full.
BATCH_DOCS, BATCH_WORDS = 1024, 600_000
#: Tokens of a bucket, about: the number of buckets follows the input, not the cluster, and so do the draws.
BUCKET_TOKENS = 2_000_000
#: Share of a batch's words from which a word counts as frequent; so there are at most 200 in a batch.
FREQUENT = 0.005
#: Stands for the end of a text, and for the context of its first word: no word holds a line feed.
END = xxhash.xxh64_intdigest(b"\n")
#: Customers of a dish up to which tables are drawn exactly.
EXACT = 64

_PACKED = "bucket int, batch long, w binary, wn binary, ctx binary, c binary, nd binary, doc binary, cnt binary, doc_ids array<long>, held array<boolean>, n_tokens array<long>"
_BUCKETS = "bucket int, batch long, w binary, wn binary, ctx binary, c binary, batches binary, bg binary, gid binary, nd binary, doc binary, cnt binary, doc_ids array<long>, held array<boolean>, n_tokens array<long>"


def held_out(doc_id: int | None, folds: int, fold: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == fold


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    change = np.zeros(len(keys[0]), bool)
    if len(change):
        change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(change)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else values[:0]


def squeezed(x: np.ndarray) -> bytes:
    """An array as a compressed cell: what passes through rows stays small."""
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def unpacked(cell: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(cell), kind)


def frequent_words(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(sorted hashes of words (and the end) that are frequent in some batch and, by what such batches count, make up at
    least half that share of all words: 400 at most; number of all tokens)."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        found: Counter[bytes] = Counter()
        total = 0
        for text in utf8(b.column("text")):
            words = text.lower().split()
            found.update(words)
            total += len(words) + 1
        often = {xxhash.xxh64_intdigest(w): n for w, n in found.items() if n >= FREQUENT * total}
        if b.num_rows >= FREQUENT * total:
            often[END] = b.num_rows
        return batch(w=longs([0, *np.array(list(often), np.uint64).view(np.int64)]), n=longs([total, *often.values()]))

    sums = map_batches(docs.select("text"), each, "w long, n long").groupBy("w").agg(F.sum("n").alias("n"))
    total = sums.where("w = 0").first()
    if total is None:
        return np.zeros(0, np.uint64), 0
    rows = sums.where((F.col("n") >= FREQUENT / 2 * total["n"]) & (F.col("w") != 0)).collect()
    return np.sort(np.array([r["w"] for r in rows], np.int64).view(np.uint64)), int(total["n"])


def _is_frequent(w: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The place of each word among the frequent ones, -1 if it isn't one."""
    if not len(frequent):
        return np.full(len(w), -1)
    at = np.minimum(np.searchsorted(frequent, w), len(frequent) - 1)
    return np.where(frequent[at] == w, at, -1)


def pack(docs: DataFrame, buckets: int, folds: int, fold: int, frequent: np.ndarray) -> DataFrame:
    """Batches of documents, cut by bucket: words, contexts of each word, and documents of each pair with counts; and
    for each batch a row that lists its documents (under any bucket, without words)."""

    def packed(number: int, ids: list, texts: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        held = [held_out(i, folds, fold) for i in ids]
        sizes = [len(t) + 1 for t in texts]
        flat = np.fromiter((h for t in texts for h in (*map(xxhash.xxh64_intdigest, t), END)), np.uint64, sum(sizes))
        before = np.concatenate([[np.uint64(END)], flat[:-1]])
        ctx = (before >> np.uint64(64 - CONTEXT_BITS)).astype(np.uint32)
        doc = np.repeat(np.arange(len(texts), dtype=np.uint32), sizes)
        low = (ctx << np.uint32(11)) | doc
        order = np.lexsort((low, flat))
        w, low = flat[order], low[order]
        pairs = _starts(w, low)
        cnt = np.diff(np.append(pairs, len(w))).astype(np.uint32)
        w, low = w[pairs], low[pairs]
        ctx, doc = low >> np.uint32(11), low & np.uint32(2047)
        train = ~np.array(held, bool)
        grams = _starts(w, ctx)
        c = _sums(cnt * train[doc], grams).astype(np.uint32)
        nd = np.diff(np.append(grams, len(w))).astype(np.uint16)
        gw, gctx = w[grams], ctx[grams].astype(np.uint16)
        by_hash = ((gw >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        to = np.where(_is_frequent(gw, frequent) >= 0, gctx.astype(np.int64) * buckets >> CONTEXT_BITS, by_hash)
        order = np.argsort(to, kind="stable")
        to, gw, gctx, c, sizes_of = to[order], gw[order], gctx[order], c[order], nd[order].astype(np.int64)
        # The documents of each pair move with it.
        ends = np.cumsum(sizes_of)
        place = np.arange(len(doc)) - np.repeat(ends - sizes_of, sizes_of) + np.repeat(grams[order], sizes_of)
        doc, cnt, nd = doc[place].astype(np.uint16), cnt[place], nd[order]
        first = _starts(to)
        p_at = np.append(0, ends)
        rows = []
        for g0, g1 in zip(first, np.append(first[1:], len(to)), strict=True):
            p0, p1 = p_at[g0], p_at[g1]
            words = _starts(gw[g0:g1])
            wn = np.diff(np.append(words, g1 - g0)).astype(np.uint32)
            rows.append((int(to[g0]), number, *(squeezed(x) for x in (gw[g0:g1][words], wn, gctx[g0:g1], c[g0:g1], nd[g0:g1], doc[p0:p1], cnt[p0:p1])), None, None, None))
        rows.append((number % buckets, number, *[None] * 7, ids, held, sizes))
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 7, pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64())]
        names = [x.split()[0] for x in _PACKED.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, texts, words = TaskContext.get().partitionId() << 32, [], [], 0
        for b in batches:
            for i, text in zip(b.column("doc_id").to_pylist(), utf8(b.column("text")), strict=True):
                ids.append(i)
                texts.append(text.lower().split())
                words += len(texts[-1])
                if len(ids) == BATCH_DOCS or words >= BATCH_WORDS:
                    yield from packed(number, ids, texts)
                    number, ids, texts, words = number + 1, [], [], 0
        if ids:
            yield from packed(number, ids, texts)

    return docs.mapInArrow(each, _PACKED)


def _rows(b: pa.RecordBatch) -> Iterator[dict]:
    """Rows one at a time: their cells are large."""
    for i in range(b.num_rows):
        yield b.slice(i, 1).to_pylist()[0]


def merge_buckets(packed: DataFrame, buckets: int) -> DataFrame:
    """One row per bucket: its words, their contexts with training counts, and per batch which of these pairs occur
    in which documents. Rows that list documents pass through."""
    names = [x.split()[0] for x in _BUCKETS.split(", ")]
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 10, pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64())]

    def merged(bucket: int, rows: list[dict]) -> pa.RecordBatch:
        cells = lambda k, kind: [unpacked(r[k], kind) for r in rows]
        contexts = cells("ctx", "<u2")
        grams = np.array(list(map(len, contexts)), np.int64)
        w = np.repeat(np.concatenate(cells("w", "<u8")), np.concatenate(cells("wn", "<u4")))
        ctx, c = np.concatenate(contexts), np.concatenate(cells("c", "<u4"))
        order = np.lexsort((ctx, w))
        starts = _starts(w[order], ctx[order])
        place = np.zeros(len(order), np.int64)
        place[starts[1:]] = 1
        gid = np.empty(len(order), np.int64)
        gid[order] = np.cumsum(place)
        total = _sums(c[order].astype(np.int64), starts)
        gw, gctx = w[order][starts], ctx[order][starts]
        words = _starts(gw)
        step, begin = np.diff(gid, prepend=0), np.append(0, np.cumsum(grams)[:-1])
        step[begin] = gid[begin]
        row = (
            bucket, None, *map(squeezed, (gw[words], np.diff(np.append(words, len(gw))).astype("<u4"), gctx, total.astype("<u8"), np.array([r["batch"] for r in rows], "<i8"),
            grams.astype("<u4"), step.astype("<u4"), *(np.concatenate(cells(k, kind)) for k, kind in (("nd", "<u2"), ("doc", "<u2"), ("cnt", "<u4"))))), None, None, None,
        )
        return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []
        for b in batches:
            for r in _rows(b):
                if r["w"] is None:
                    listed = (r["bucket"], r["batch"], *[None] * 10, r["doc_ids"], r["held"], r["n_tokens"])
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(listed, kinds, strict=True)], names)
                    continue
                if r["bucket"] != bucket and rows:
                    yield merged(bucket, rows)
                    rows = []
                bucket = r["bucket"]
                rows.append(r)
        if rows:
            yield merged(bucket, rows)

    return packed.repartitionById(buckets, F.col("bucket")).sortWithinPartitions("bucket").mapInArrow(each, _BUCKETS)


@dataclass(frozen=True)
class Prior:
    """Discount and strength of the context restaurants and of the parent."""

    d: float = 0.8
    theta: float = 1.0
    d1: float = 0.7
    theta1: float = 10.0


@dataclass
class Totals:
    """What all buckets share after a sweep: tables by context, customers and tables of the parent."""

    tables: np.ndarray
    customers1: int
    tables1: int
    frequent_customers1: np.ndarray
    frequent_tables1: np.ndarray


@dataclass
class Shared:
    frequent: np.ndarray
    frequent_c: np.ndarray
    customers: np.ndarray
    n: int
    v: int
    sweeps: list[Totals] = field(default_factory=list)


def log_stirling(d: float, size: int = EXACT) -> np.ndarray:
    """log S[c, t]: generalised Stirling numbers of discount d."""
    s = np.full((size + 1, size + 1), -np.inf)
    s[0, 0] = 0.0
    for c in range(size):
        t = np.arange(1, c + 2)
        s[c + 1, 1 : c + 2] = np.logaddexp(s[c, t - 1], np.where(c - d * t > 0, np.log(np.maximum(c - d * t, 1e-300)), -np.inf) + s[c, t])
    return s


def draw_tables(c: np.ndarray, others: np.ndarray, logp: np.ndarray, d: float, theta: float, stirling: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish given its customers `c`, the tables of the other dishes of its restaurant, and the log
    probability of the dish in the parent. Exact up to EXACT customers; those beyond are seated in growing blocks."""
    t = np.minimum(c, 1).astype(np.int64)
    small = np.minimum(c, EXACT)
    order = np.argsort(small, kind="stable")
    bounds = np.searchsorted(small[order], np.arange(2, EXACT + 2))
    for k in range(2, EXACT + 1):
        same = order[bounds[k - 2] : bounds[k - 1]]
        for part in np.array_split(same, max(1, len(same) * k // 400_000 + 1)) if len(same) else ():
            rising = np.cumsum(np.log(theta + d * (others[part, None] + np.arange(k))), axis=1)
            weights = stirling[k, 1 : k + 1] + rising + logp[part, None] * np.arange(1, k + 1)
            t[part] = 1 + np.argmax(weights + rng.gumbel(size=weights.shape), axis=1)
    big = np.flatnonzero(c > EXACT)
    seated = np.full(len(big), EXACT, np.float64)
    p = np.exp(logp[big])
    while len(big):
        room = c[big] - seated
        if not (room > 0).any():
            break
        block = np.minimum(np.maximum(np.floor(seated / 4), 1), np.maximum(room, 0))
        new = (theta + d * (others[big] + t[big])) * p
        t[big] += rng.binomial(block.astype(np.int64), new / (new + np.maximum(seated - d * t[big], 1e-9)))
        seated += block
    return t


class Seating:
    """A bucket's restaurants; `sweep` takes them through one sweep, `probabilities` predicts."""

    def __init__(self, row: dict, shared: Shared, prior: Prior, seed: int):
        self.prior, self.shared, self.seed = prior, shared, seed
        self.wn = unpacked(row["wn"], "<u4").astype(np.int64)
        self.ctx = unpacked(row["ctx"], "<u2").astype(np.int64)
        self.c = unpacked(row["c"], "<u8").astype(np.int64)
        self.bucket = row["bucket"]
        self.starts = np.append(0, np.cumsum(self.wn)[:-1])
        self.word_c = _sums(self.c, self.starts)
        at = _is_frequent(unpacked(row["w"], "<u8"), shared.frequent)
        self.spread, self.spread_at = np.flatnonzero(at >= 0), at[at >= 0]
        self.own_c = self.word_c[self.spread]
        if len(shared.frequent_c):
            self.word_c[self.spread] = shared.frequent_c[self.spread_at]
        self.t = np.minimum(self.c, 1)
        self.t1 = np.minimum(self.word_c, 1)
        self.s, self.s1 = log_stirling(prior.d), log_stirling(prior.d1)

    def customers1(self) -> np.ndarray:
        return _sums(self.t, self.starts)

    def parent(self, totals: Totals) -> np.ndarray:
        """Probability of each word in the parent."""
        p = self.prior
        base = 1.0 / (self.shared.v + 1)
        c1, t1 = self.customers1(), self.t1.copy()
        c1[self.spread], t1[self.spread] = totals.frequent_customers1[self.spread_at], totals.frequent_tables1[self.spread_at]
        return (c1 - p.d1 * t1 + (p.theta1 + p.d1 * totals.tables1) * base) / (p.theta1 + totals.customers1)

    def sweep(self, number: int, totals: Totals) -> None:
        p, rng = self.prior, np.random.default_rng([self.seed, self.bucket, number])
        again = np.flatnonzero(self.c > 1)
        logp = np.log(np.repeat(self.parent(totals), self.wn)[again])
        others = np.maximum(totals.tables[self.ctx[again]] - self.t[again], 0)
        self.t[again] = draw_tables(self.c[again], others, logp, p.d, p.theta, self.s, rng)
        c1 = self.customers1()
        base = np.full(len(c1), -np.log(self.shared.v + 1.0))
        self.t1 = draw_tables(c1, np.maximum(totals.tables1 - self.t1, 0), base, p.d1, p.theta1, self.s1, rng)

    def probabilities(self, totals: Totals) -> np.ndarray:
        """Probability of each pair's word in its context, under this sample."""
        p, u = self.prior, self.ctx
        mass = p.theta + self.shared.customers[u]
        return (self.c - p.d * self.t + (p.theta + p.d * totals.tables[u]) * np.repeat(self.parent(totals), self.wn)) / mass

    def totals_rows(self, first: bool) -> Iterator[pa.RecordBatch]:
        """Sums of this bucket, by context; -1 to -3 stand for the parent's customers and tables, and words, of words that
        are here alone, -4 and below for the frequent words."""
        tables = np.bincount(self.ctx, weights=self.t, minlength=CONTEXTS).astype(np.int64)
        customers = np.bincount(self.ctx, weights=self.c, minlength=CONTEXTS).astype(np.int64)
        seen = np.flatnonzero(customers)
        alone = np.ones(len(self.wn), bool)
        alone[self.spread] = False
        yield batch(
            u=longs([-1, -2, -3, *(-4 - self.spread_at), *seen]),
            tables=longs([int(self.t.sum()), int(self.t1[alone].sum()), int((self.word_c[alone] > 0).sum()), *self.customers1()[self.spread], *tables[seen]]),
            customers=longs([0, 0, 0, *self.own_c, *(customers[seen] if first else np.zeros(len(seen), np.int64))]),
        )


def _summed(buckets: DataFrame, shared: Shared, prior: Prior, seed: int) -> Shared:
    """`shared` with the totals of one sweep more, as many rows as there are contexts and frequent words."""
    sent = buckets.sparkSession.sparkContext.broadcast(shared)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in _rows(b):
                seats = Seating(row, sent.value, prior, seed)
                for k, totals in enumerate(sent.value.sweeps):
                    seats.sweep(k + 1, totals)
                yield from seats.totals_rows(not sent.value.sweeps)

    rows = buckets.where("w is not null").select("bucket", "w", "wn", "ctx", "c").mapInArrow(each, "u long, tables long, customers long")
    found = rows.groupBy("u").agg(F.sum("tables").alias("tables"), F.sum("customers").alias("customers")).toPandas()

    def vector(part, size: int, column: str) -> np.ndarray:
        out = np.zeros(size, np.int64)
        out[part["u"].to_numpy(np.int64)] = part[column].to_numpy(np.int64)
        return out

    own = found[found["u"] >= 0]
    spread = found[found["u"] <= -4].assign(u=lambda x: -4 - x["u"])
    special = found.set_index("u")["tables"].to_dict()
    c1 = vector(spread, len(shared.frequent), "tables")
    if not shared.sweeps:
        customers, counts = vector(own, CONTEXTS, "customers"), vector(spread, len(shared.frequent), "customers")
        words = int(special.get(-3, 0)) + int((counts > 0).sum())
        shared = Shared(shared.frequent, counts, customers, int(customers.sum()), words)
        t1 = np.minimum(c1, 1)
    else:
        before, rng = shared.sweeps[-1], np.random.default_rng([seed, len(shared.sweeps)])
        others = np.maximum(before.tables1 - before.frequent_tables1, 0)
        base = np.full(len(c1), -np.log(shared.v + 1.0))
        t1 = draw_tables(c1, others, base, prior.d1, prior.theta1, log_stirling(prior.d1), rng)
    totals = Totals(vector(own, CONTEXTS, "tables"), int(special.get(-1, 0)), int(special.get(-2, 0)) + int(t1.sum()), c1, t1)
    return Shared(shared.frequent, shared.frequent_c, shared.customers, shared.n, shared.v, [*shared.sweeps, totals])


def train(buckets: DataFrame, frequent: np.ndarray, prior: Prior, sweeps: int, seed: int) -> Shared:
    """Totals of the first seating (a table for each dish) and of `sweeps` sweeps."""
    shared = Shared(frequent, np.zeros(0, np.int64), np.zeros(CONTEXTS, np.int64), 0, 0)
    for _ in range(sweeps + 1):
        shared = _summed(buckets, shared, prior, seed)
    return shared


def bucket_scores(row: dict, shared: Shared, prior: Prior, burn_in: int, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each batch: its documents that have words of the bucket, their log10 probability, base score, known tokens."""
    seats, total, used = Seating(row, shared, prior, seed), 0.0, 0
    for k, totals in enumerate(shared.sweeps):
        if k > 0:
            seats.sweep(k, shared.sweeps[k - 1])
        if k > burn_in or k == len(shared.sweeps) - 1 and not used:
            total, used = total + seats.probabilities(totals), used + 1
    logp = np.log10(total / used)
    base = np.repeat(np.log10((seats.word_c + 1.0) / (shared.n + shared.v + 1.0)), seats.wn)
    known = np.repeat(seats.word_c > 0, seats.wn).astype(np.int8)
    grams, step = unpacked(row["bg"], "<u4").astype(np.int64), unpacked(row["gid"], "<u4").astype(np.int64)
    nd, doc, cnt = unpacked(row["nd"], "<u2"), unpacked(row["doc"], "<u2"), unpacked(row["cnt"], "<u4")
    del seats, total
    g = p = 0
    for number, n in zip(unpacked(row["batches"], "<i8"), grams, strict=True):
        own = nd[g : g + n]
        at = np.repeat(np.cumsum(step[g : g + n]), own)
        q = p + len(at)
        d, times = doc[p:q], cnt[p:q]
        docs = np.flatnonzero(np.bincount(d))
        sums = [np.bincount(d, weights=x[at] * times)[docs] for x in (logp, base, known)]
        yield int(number), docs, *sums
        g, p = g + n, q


def score_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    folds: int = 7,
    fold: int = 2,
    prior: Prior = Prior(),  # noqa: B008
    sweeps: int = 3,
    burn_in: int = 1,
    seed: int = 1,
) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    The model learns from the documents whose crc32(doc_id as text) modulo `folds` isn't `fold` and scores all.
    Tokens are the text's words (A-Z lowered, between ASCII white space) and one end. `score` is the model's log10
    probability of the text; `base_score` that of single words with one added to each count. A word unseen in training
    has the probability of the one unknown word.

    A null or empty text is an end alone; a null id counts as an empty one; repeated rows are documents each;
    other columns don't matter; an empty table gives an empty result. Without any training document, all words are
    unknown. A text of any length belongs to one batch, whose words one task holds.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    frequent, tokens = frequent_words(source)
    parts = max(1, -(-tokens // BUCKET_TOKENS))
    buckets = materialise(merge_buckets(pack(source, parts, folds, fold, frequent), parts), "lm-buckets")
    shared = train(buckets, frequent, prior, sweeps, seed)
    sent = spark.sparkContext.broadcast(shared)  # a few vectors of one entry per context
    names = ["batch", "docs", "score", "base", "known"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in _rows(b):
                for number, own, s, base, known in bucket_scores(row, sent.value, prior, burn_in, seed):
                    cells = [own.astype("<u2").tobytes(), s.astype("<f4").tobytes(), base.astype("<f8").tobytes(), known.astype("<u4").tobytes()]
                    yield pa.RecordBatch.from_arrays([longs([number]), *(pa.array([x], pa.binary()) for x in cells)], names)

    kind = "batch long, docs binary, score binary, base binary, known binary"
    columns = ["bucket", "w", "wn", "ctx", "c", "batches", "bg", "gid", "nd", "doc", "cnt"]
    parted = buckets.where("w is not null").select(*columns).mapInArrow(score, kind)
    listed = buckets.where("doc_ids is not null").select("batch", "doc_ids", "held", "n_tokens")
    rows = parted.unionByName(listed, allowMissingColumns=True).repartition(parts, "batch").sortWithinPartitions("batch", F.col("doc_ids").isNull())

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, sums = None, None

        def done() -> pa.RecordBatch:
            s, base, known = sums
            return batch(
                doc_id=longs(head["doc_ids"]), held_out=pa.array(head["held"], pa.bool_()), n_tokens=longs(head["n_tokens"]), n_known=longs(known.astype(np.int64)),
                base_score=pa.array(base, pa.float64()), score=pa.array(s, pa.float64()),
            )

        for b in batches:
            for r in b.to_pylist():
                if r["doc_ids"] is not None:
                    if head:
                        yield done()
                    head, sums = r, np.zeros((3, len(r["doc_ids"])))
                else:
                    at = np.frombuffer(r["docs"], "<u2")
                    sums[0, at] += np.frombuffer(r["score"], "<f4")
                    sums[1, at] += np.frombuffer(r["base"], "<f8")
                    sums[2, at] += np.frombuffer(r["known"], "<u4")
        if head:
            yield done()

    found = rows.mapInArrow(gather, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(shared.n).cast("long").alias("train_tokens"), "base_score", "score", perplexity.alias("perplexity"))


def op6_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"))
