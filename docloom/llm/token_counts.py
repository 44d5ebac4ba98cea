"""Token counts by byte-pair merging, without token identifiers in the result.

Each piece of a text is merged with a heap of ranked adjacent pairs and a doubly linked list of symbols: the pair
of lowest rank (leftmost at a tie) is popped and merged until no ranked pair is left. The count is the number of
initial symbols minus the number of merges.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import longs, map_batches, read, utf8

#: Words whose counts a worker keeps; beyond that it starts anew. Bounds memory, not results.
KEPT_WORDS = 1_000_000


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself where printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PairMerger:
    """Counts the tokens of a text under a byte-level BPE vocabulary with word ends (tokenizers' JSON file)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        suffix = len(end)
        self.ranks = {}
        for rank, (a, b) in enumerate(pairs):
            joined = (a[:-suffix] if suffix and a.endswith(end) else a) + b
            self.ranks[vocab[a], vocab[b]] = (rank, vocab[joined])
        letters = byte_letters()
        self.inner = [vocab[letters[b]] for b in range(256)]
        self.last = [vocab[letters[b] + end] for b in range(256)]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.pieces = regex.compile(next(s for s in steps if s["type"] == "Split")["pattern"]["Regex"])
        special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def merged(self, piece: bytes) -> int:
        """Initial symbols minus merges of one piece."""
        n = len(piece)
        if n < 2:
            return n
        sym = [self.inner[b] for b in piece]
        sym[-1] = self.last[piece[-1]]
        after, before, ranks = [*range(1, n), -1], [*range(-1, n - 1)], self.ranks
        heap = [(r[0], i, a, b, r[1]) for i, (a, b) in enumerate(zip(sym, sym[1:])) if (r := ranks.get((a, b)))]
        heapq.heapify(heap)
        count = n
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j < 0 or sym[j] != b:
                continue  # one of the two has been merged away
            sym[i], sym[j], after[i] = new, -1, (k := after[j])
            count -= 1
            if k >= 0:
                before[k] = i
                if r := ranks.get((new, sym[k])):
                    heapq.heappush(heap, (r[0], i, new, sym[k], r[1]))
            if (h := before[i]) >= 0 and (r := ranks.get((sym[h], new))):
                heapq.heappush(heap, (r[0], h, sym[h], new, r[1]))
        return count

    def count(self, text: str) -> int:
        """Tokens of any text; a special string counts one, as the library has it by default."""
        total, parts = 0, [text]
        if self.special and "<" in text:
            parts = self.special.split(text)
            total = len(parts) - 1
        for part in parts:
            part = unicodedata.normalize("NFC", part)
            part = part.lower() if part.isascii() else "".join(c.lower() for c in part)
            total += sum(self.merged(p.encode()) for p in self.pieces.findall(part))
        return total


class WordCounts(dict):
    """Tokens of each white-space separated word seen so far: no piece reaches over ASCII white space."""

    def __init__(self, merger: PairMerger):
        super().__init__()
        self.merger = merger

    def __missing__(self, word: bytes) -> int:
        n = self.merger.count(word.decode("utf-8", "replace"))
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = n
        return n

    def of(self, text: bytes) -> int:
        return sum(map(self.__getitem__, text.split()))


@lru_cache(maxsize=4)
def word_counts(path: str) -> WordCounts:
    """One per worker process and vocabulary file."""
    return WordCounts(PairMerger(path))


def count_tokens(df: DataFrame, path: str, text: str = "text", count: str = "n_tokens", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all but `text`) with n_bytes (UTF-8) and the token count of each whole text.

    A narrow map, no shuffle. A null or empty text has 0 bytes and 0 tokens; other columns may be null and pass
    unchanged; repeated rows are counted each; an empty table gives an empty one. Columns of the input named
    n_bytes or like `count` are replaced. The vocabulary must be at `path` on every machine.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c not in (text, "n_bytes", count)]
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = utf8(b.column(len(keep)))
        of = word_counts(path).of
        return pa.RecordBatch.from_arrays(
            [*b.columns[: len(keep)], longs([len(t) for t in texts]), longs([of(t) for t in texts])], [*keep, "n_bytes", count]
        )

    return map_batches(df.select(*(F.col(f"`{c}`") for c in keep), F.col(text)).toDF(*(f"c{i}" for i in range(len(keep) + 1))), each, f"{schema}{', ' if keep else ''}n_bytes long, `{count}` long")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep=["doc_id"])
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)
