"""Benchmark decontamination with spaced seeds.

A mask of cared and ignored positions turns a window of tokens into a seed: a hash of the cared tokens only, so a
substitution at an ignored position leaves it as it is. Seeds of documents and of benchmark items that are equal give
a diagonal (document, item, offset), along which overlaps are grown around its hits and measured, with substitutions
tolerated up to a share. Stretches on neighbouring diagonals, between which words were put in or left out, are added up.
Items of up to twelve tokens are looked up by their halves, one of which a single exchange leaves as it is; those
of fewer than six whole.

Texts are lower-cased, ASCII punctuation is dropped, tokens stand between ASCII white space. Benchmark items are taken
in blocks of a bounded number of tokens; each block goes to all tasks and all documents are scanned against it, so
nothing of the documents is shuffled but hits, and the benchmark may be of any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.checkpoints import materialise
from docloom.llm.common import hand_back, longs, parts, plain_names, read, utf8

#: Cared positions of the masks (weight 6); windows of six to eleven tokens. Of items of 40 tokens that a text overlaps
#: on some diagonal they find 0.99 with every fifth token exchanged, 0.98 with every fourth.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 3, 6, 7, 9), (0, 2, 3, 7, 8, 10), (0, 1, 4, 5, 8, 9))
#: Hits of a document, or tokens on its diagonals, that are looked at together, about.
AT_ONCE = 1 << 20
#: Items of up to so many tokens are looked up by halves.
HALVED = 12
#: Periods at which repeated words are told, so that texts and items of few different words make few hits.
PERIODS = range(1, 7)
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Benchmark tokens of one block, which every task holds: a few tens of MB at most.
BLOCK_TOKENS = 200_000


def tokens(data: bytes) -> list[bytes]:
    return data.decode("utf-8", "replace").lower().encode().translate(None, PUNCTUATION).split()


def _terms(ids: np.ndarray, weight: int) -> list[np.ndarray]:
    """Each id times the odd number of each cared position: what all masks of a weight share."""
    return [ids.astype(np.uint64) * np.uint64((0x9E3779B97F4A7C15 * (2 * i + 1)) & ((1 << 64) - 1) | 1) for i in range(weight)]


def seeds(ids: np.ndarray, mask: tuple[int, ...], terms: list[np.ndarray] | None = None) -> np.ndarray:
    """The seed at every window start, 0 where a cared token is unknown (id 0)."""
    n = len(ids) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    terms, some = terms or _terms(ids, len(mask)), ids != 0
    h, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for k, term in zip(mask, terms, strict=False):
        h += term[k : k + n]
        known &= some[k : k + n]
    h ^= h >> np.uint64(29)
    h |= np.uint64(1)
    h[~known] = 0
    return h


def repeats(ids: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(period, how many known tokens up to each place equal the one a period before) of the periods that some window may have."""
    found = []
    for r in PERIODS:
        same = ids[r:] == ids[:-r]
        if np.count_nonzero(same) > MASKS[0][-1]:
            same &= ids[r:] != 0
            found.append((r, np.concatenate([[0], np.cumsum(same)])))
    return found


def periods(n: int, mask: tuple[int, ...], repeated: list[tuple[int, np.ndarray]]) -> np.ndarray | None:
    """At each of `n` window starts, the smallest period at which the window goes on repeating what stands before it, else 0; None
    if there is none. Only periods count of which the mask sees every place: then equal seeds mean equal windows."""
    found, span = None, mask[-1] + 1
    for r, sums in repeated:
        if n <= r or len({k % r for k in mask}) < r:
            continue
        whole = sums[span:] - sums[:-span] == span
        if whole.any():
            found = np.zeros(n, np.int8) if found is None else found
            own = found[r:]
            own[whole & (own == 0)] = r
    return found


def grown(same: np.ndarray, at: int, penalty: float) -> tuple[int, int, int]:
    """(begin, end, matches) of the best-scoring stretch around position `at` of a diagonal: a match counts 1, a
    substitution -penalty."""
    score = np.where(same, 1.0, -penalty)
    right = np.cumsum(score[at:])
    left = np.cumsum(score[:at][::-1])
    end = at + int(np.argmax(right)) + 1
    begin = at - (int(np.argmax(left)) + 1 if len(left) and left.max() > 0 else 0)
    return begin, end, int(same[begin:end].sum())


def _chunks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive groups whose sizes sum up to `most`, about."""
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - 1) // most)) + 1 if sizes.sum() > most else []
    bounds = [0, *cuts, len(sizes)]
    yield from zip(bounds[:-1], bounds[1:], strict=True)


def _run_starts(item: np.ndarray, offset: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by diagonal and place, of places side by side or equal only the first."""
    order = np.lexsort((p, offset, item))
    item, offset, p = item[order], offset[order], p[order]
    new = np.ones(len(p), bool)
    new[1:] = (item[1:] != item[:-1]) | (offset[1:] != offset[:-1]) | (p[1:] > p[:-1] + 1)
    return item[new], offset[new], p[new]


class Block:
    """Benchmark items with their seeds."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.names, self.ids = [], []
        for name, text in items:
            self.names.append(name)
            self.ids.append(np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in tokens(text)], np.int64))
        self.sizes = np.array(list(map(len, self.ids)), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.concatenate([*self.ids, np.zeros(0, np.int64)])
        self.tables, self.short = [], []
        for size in range(1, MASKS[0][-1] + 1):
            own = [(int(seeds(ids, tuple(range(size)))[0]), i) for i, ids in enumerate(self.ids) if len(ids) == size]
            if own:
                h, which = np.unique(np.array([x for x, _ in own], np.uint64), return_inverse=True)
                items = [[i for (_, i), w in zip(own, which, strict=True) if w == k] for k in range(len(h))]
                self.short.append((size, h, items))
        for mask in MASKS:
            found = []
            for i, ids in enumerate(self.ids):
                own = seeds(ids, mask)
                period = periods(len(own), mask, repeats(ids))
                found += [(x, i, k, 0 if period is None else int(period[k])) for k, x in enumerate(own) if x]
            self.tables.append((mask, *self._sorted(found), np.array([x[3] for x in sorted(found)], np.int8)))
        self.halves = []
        near = [(i, ids) for i, ids in enumerate(self.ids) if MASKS[0][-1] < len(ids) <= HALVED]
        for length in range(len(MASKS[0]) // 2, HALVED // 2 + 1):
            found = [(seeds(ids, tuple(range(length)))[k], i, k) for i, ids in near for k in (0, len(ids) - length) if length == (len(ids) // 2 if k == 0 else len(ids) - len(ids) // 2)]
            if found:
                self.halves.append((tuple(range(length)), *self._sorted(found)))

    @staticmethod
    def _sorted(found: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        found = sorted(found)
        return np.array([x[0] for x in found], np.uint64), np.array([x[1:3] for x in found], np.int64).reshape(-1, 2)

    @staticmethod
    def _located(s: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Those of the positions `at` whose seeds are in the table, where in it, and how many times."""
        if not len(table) or not len(at):
            return at[:0], at[:0], at[:0]
        own = s[at]
        first = np.searchsorted(table, own)
        first[first == len(table)] = 0
        ok = table[first] == own
        at, first = at[ok], first[ok]
        return at, first, np.searchsorted(table, s[at], "right") - first

    @staticmethod
    def _met(at: np.ndarray, first: np.ndarray, many: np.ndarray, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(item, place in it, position) of what is located, some at a time."""
        if not len(at):
            return
        for i, j in _chunks(many, AT_ONCE):
            n = many[i:j]
            item, k = places[np.repeat(first[i:j] - np.cumsum(n) + n, n) + np.arange(n.sum())].T
            yield item, k, np.repeat(at[i:j], n)

    def hits(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """(item, offset of the item in the document, hit position in the document), in this order. Of hits side by side on a
        diagonal, which match in every token, the first is told; and where text and item both go on with one period, the hit
        a period before stands for the next, so those of repeated words are as many as positions, not as pairs."""
        found, terms = [], _terms(ids, len(MASKS[0]))
        for mask, table, places, period in self.tables:
            s = seeds(ids, mask, terms)
            located = self._located(s, np.flatnonzero(s), table)
            # periods are looked for where the pairs are many; they change no stretch
            own = periods(len(s), mask, repeats(ids)) if located[2].sum() > AT_ONCE else None
            if own is None:
                found += [_run_starts(item, p - k, p) for item, k, p in self._met(*located, places)]
                continue
            for r in np.unique(own):
                others = np.ones(len(period), bool) if r == 0 else period != r
                located = self._located(s, np.flatnonzero((s != 0) & (own == r)), table[others])
                found += [_run_starts(item, p - k, p) for item, k, p in self._met(*located, places[others])]
        if not found:
            return None
        return found[0] if len(found) == 1 else _run_starts(*(np.concatenate(x) for x in zip(*found, strict=True)))

    def matches(self, ids: np.ndarray, item: np.ndarray, offset: np.ndarray) -> np.ndarray:
        """How many tokens match on each whole diagonal."""
        begin, end = np.maximum(offset, 0), np.minimum(offset + self.sizes[item], len(ids))
        length, out = end - begin, []
        for i, j in _chunks(length, AT_ONCE):
            n = length[i:j]
            starts = np.cumsum(n) - n
            within = np.arange(n.sum()) - np.repeat(starts, n)
            same = ids[np.repeat(begin[i:j], n) + within] == self.flat[np.repeat(self.starts[item[i:j]] + begin[i:j] - offset[i:j], n) + within]
            out.append(np.add.reduceat(same, starts, dtype=np.int64))
        return np.concatenate(out)

    def along(self, ids: np.ndarray, item: int, d: int, hits: np.ndarray, penalty: float) -> Iterator[tuple[int, int, int, int]]:
        """(offset, begin, end, matches) of the stretches around the hits of a diagonal, by place."""
        own, done = self.ids[item], -1
        a, b = max(0, d), min(len(ids), d + len(own))
        same = ids[a:b] == own[a - d : b - d]
        for x in hits.tolist():
            if x >= done:  # others lie in a stretch that is known
                begin, end, matches = grown(same, x - a, penalty)
                done = a + end
                yield d, a + begin, a + end, matches

    def stretches(self, ids: np.ndarray, penalty: float, single: np.ndarray, whole: np.ndarray) -> tuple[dict[int, tuple[int, int, int]], dict[int, list]]:
        """The best stretch (matches, -begin, end) of each item one of whose stretches matches `single` of its tokens; of other
        items whose diagonals that have hits match `whole` of them together, all stretches by offset and place.

        An item's longest diagonals are measured first. One that is too short to hold a better stretch than the best so
        far, or an equal one that begins earlier, isn't looked at, so repeated words cost about one diagonal an item.
        """
        best: dict[int, tuple[int, int, int]] = {}
        others: dict[int, list[tuple[int, int, int, int]]] = {}
        if (hits := self.hits(ids)) is None:
            return best, others
        item, offset, p = hits
        first = np.flatnonzero(np.append(True, (item[1:] != item[:-1]) | (offset[1:] != offset[:-1])))
        of, at, last = item[first], offset[first], np.append(first[1:], len(p))
        begin, m = np.maximum(at, 0), np.zeros(len(at), np.int64)
        length = np.minimum(at + self.sizes[of], len(ids)) - begin
        most, where = np.full(len(self.ids), -1), np.zeros(len(self.ids), np.int64)
        better = lambda g, n: (n > most[of[g]]) | (n == most[of[g]]) & (begin[g] <= where[of[g]])
        left = np.lexsort((begin, -length, of))
        new = np.append(True, of[left][1:] != of[left][:-1])
        rank = np.arange(len(left)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        left = left[np.argsort(rank, kind="stable")]
        while len(left):
            n = max(1, int(np.searchsorted(np.cumsum(length[left]), AT_ONCE, "right")))
            now, left = left[:n], left[n:]
            m[now] = self.matches(ids, of[now], at[now])
            now = now[m[now] >= single[of[now]]]
            for g in now[np.lexsort((begin[now], -m[now]))]:
                i = int(of[g])
                if better(g, m[g]):
                    enough = [(n, -b, e) for _, b, e, n in self.along(ids, i, int(at[g]), p[first[g] : last[g]], penalty) if n >= single[i]]
                    if enough and (i not in best or max(enough) > best[i]):
                        best[i] = max(enough)
                        most[i], where[i] = best[i][0], -best[i][1]
            left = left[better(left, length[left])]
        together = (np.bincount(of, m, len(self.ids)) >= whole) & (most < 0)
        for g in np.flatnonzero(together[of]):
            others.setdefault(int(of[g]), []).extend(self.along(ids, int(of[g]), int(at[g]), p[first[g] : last[g]], penalty))
        return best, others

    def by_halves(self, ids: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, tuple[int, int, int]]]:
        """(item, (matches, -begin, end)) of the places where an item of up to HALVED tokens stands in the text with `least`
        of its tokens, one half of it whole."""
        for mask, table, places in self.halves:
            s = seeds(ids, mask)
            for item, k, p in self._met(*self._located(s, np.flatnonzero(s), table), places):
                inside = (p >= k) & (p - k + self.sizes[item] <= len(ids))
                item, offset = item[inside], (p - k)[inside]
                if not len(item):
                    continue
                m = self.matches(ids, item, offset)
                enough = m >= least[item]
                item, offset, m = item[enough], offset[enough], m[enough]
                order = np.lexsort((offset, -m, item))
                for g in order[np.append(True, item[order][1:] != item[order][:-1])[: len(order)]]:
                    i, d = int(item[g]), int(offset[g])
                    yield i, (int(m[g]), -d, d + len(self.ids[i]))

    def together(self, ids: np.ndarray, item: int, parts: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, int]]:
        """(matches, begin, end) of the parts on neighbouring diagonals; a token of the item counts once."""
        own, group = self.ids[item], []
        for part in [*parts, None]:
            if group and (part is None or part[0] - group[-1][0] > max(8, len(own) // 4)):
                if len(group) > 1:
                    seen = np.zeros(len(own), bool)
                    for offset, begin, end, _ in group:
                        seen[begin - offset : end - offset] |= ids[begin:end] == own[begin - offset : end - offset]
                    yield int(seen.sum()), min(x[1] for x in group), max(x[2] for x in group)
                group = []
            group.append(part)

    def overlaps(self, data: bytes, min_share: float, min_matches: int, penalty: float, stretch: int) -> list[tuple[int, int, int, int]]:
        """(item id, first token, end, matches) of each item that overlaps enough: its best stretch, or else its best
        group of stretches."""
        words = tokens(data)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))
        least = np.maximum(np.minimum(min_matches, self.sizes), min_share * self.sizes)
        best, others = self.stretches(ids, penalty, np.minimum(np.minimum(stretch, self.sizes), least), least)
        for item, parts in others.items():
            if enough := [(m, -begin, end) for m, begin, end in self.together(ids, item, parts) if m >= least[item]]:
                best[item] = max(enough)
        if self.halves:
            for item, found in self.by_halves(ids, np.maximum(np.minimum(min_matches, self.sizes - 1), min_share * self.sizes)):
                best[item] = max(best.get(item, found), found)
        for size, table, items in self.short:
            s = seeds(ids, tuple(range(size)))
            at = np.minimum(np.searchsorted(table, s), len(table) - 1)
            places = np.flatnonzero(table[at] == s)
            for k, first in zip(*np.unique(at[places], return_index=True), strict=True):
                p = int(places[first])
                best |= {i: (size, -p, p + size) for i in items[k] if np.array_equal(ids[p : p + size], self.ids[i])}
        return [(self.names[i], -b, e, m) for i, (m, b, e) in sorted(best.items())]


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, bytes]]]:
    """The items, a bounded number of tokens at a time; the driver holds one block."""
    held, size = [], 0
    for row in benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where("t is not null").orderBy("i", "t").toLocalIterator():
        data = row["t"].encode()
        held.append((row["i"], data))
        size += len(data.split())
        if size >= BLOCK_TOKENS:
            yield held
            held, size = [], 0
    if held:
        yield held


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    min_share: float = 0.5,
    min_matches: int = 10,
    penalty: float = 2.0,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep: str | None = None,
    stretch: int = 13,
) -> DataFrame:
    """(doc_id, item_id, first_token, end_token, matches): every benchmark item that a document overlaps.

    An item counts as overlapped if the stretch around some seed hit matches `stretch` of its tokens or more (all, if
    the item is shorter), however long the item; or if a stretch, or stretches together whose diagonals lie side by
    side, match at least `min_share` of its tokens and at least `min_matches` of them (all, if the item is shorter).
    `penalty` tolerates one substitution for that many matches. Items of 6 to 12 tokens also count where they stand with one
    token exchanged (of 12 two, if one half is whole). Items of fewer tokens than the shortest window (6) count where they stand
    whole; of these the first place is told.

    Null and empty texts, of documents and items, overlap nothing; rows with null or equal ids are looked at each;
    repeated rows give repeated results; other columns are ignored; an empty table on either side gives an empty
    result. With `keep` the result carries that column of `docs` in place of doc_id.
    """
    named = keep or doc_id
    kind = docs.schema[named].dataType.simpleString()
    schema = f"`{named}` {kind}, item_id long, first_token long, end_token long, matches long"
    source = docs.select(F.col(named), F.col(text).alias("__text"))
    found = None
    for items in _blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(items)  # at most BLOCK_TOKENS tokens

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            block = Block(shared.value)
            for b in (part for whole in batches for part in parts(whole)):
                rows = [(i, *x) for i, data in enumerate(utf8(b.column("__text"))) for x in block.overlaps(data, min_share, min_matches, penalty, stretch)]
                if rows:
                    at, item, first, end, matches = zip(*rows, strict=True)
                    columns = [b.column(named).take(pa.array(at)), *(longs(x) for x in (item, first, end, matches))]
                    yield pa.RecordBatch.from_arrays(columns, [named, "item_id", "first_token", "end_token", "matches"])
            hand_back()

        hits = source.mapInArrow(scan, schema)
        found = hits if found is None else found.unionAll(hits)
    return found if found is not None else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", **how) -> DataFrame:
    """The rows of `docs` that overlap no benchmark item. The verdict hangs on the text alone, so the rows to go are
    known by their text's digest; what is joined is the digests of overlapping texts."""
    plain, (text,) = plain_names(docs, text)
    tagged = plain.withColumn("__digest", F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))))
    # A table of known size: Spark broadcasts it while it is small, and no text is shuffled.
    bad = materialise(overlaps(tagged, benchmark, text=text, keep="__digest", **how).select("__digest").distinct(), "overlapping")
    return tagged.join(bad, "__digest", "left_anti").select(*plain.columns).toDF(*docs.columns)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
