"""Exact encoding and decoding with SentencePiece vocabularies of the merge type (BPE).

A sequence of pieces is what merging makes of a text exactly if each piece is what merging makes of itself, and each two
neighbours are what it makes of the two together: a merge over a border in the text would also happen between those two
alone. So no text is merged as a whole. An Aho-Corasick automaton finds the longest piece that begins at each character;
the encoder takes the longest that its left neighbour bears (checked by merging the two anew, remembered by pair), tries
shorter ones where it doesn't, and steps back where none is left. A bitfield of positions from which there is no way on
keeps the whole linear.

White space can only begin pieces of such a vocabulary, so texts fall into words that don't depend on each other; a
worker remembers the ids of words that it has seen.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import map_batches, read, utf8
from docloom.llm.token_ids import _gathered

#: The letter that stands for a blank in pieces, and what an unknown piece is decoded to: fixed values of the format.
BLANK, UNKNOWN = "▁", " ⁇ "
#: Words and pairs of pieces that a worker remembers, about; then it begins anew. Bounds memory, not results.
KEPT_WORDS, KEPT_PAIRS = 600_000, 1_000_000
#: Longer words are encoded each time they come.
LONG_WORD = 64


def _one_by_one(e: UnicodeError) -> tuple[str, int]:
    """Each byte that begins no character becomes a replacement character."""
    return "�", e.start + 1


codecs.register_error("docloom-one-by-one", _one_by_one)


class PieceEncoder:
    """Encodes words, and decodes ids, under a vocabulary of the merge type with byte fallback and a blank before the
    text, whose normalizer changes nothing but blanks."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(library.get_piece_size())
        self.pieces = [library.id_to_piece(i) for i in size]
        self.end_id = library.eos_id()
        self.control = {i for i in size if library.is_control(i)}
        self.unknown = library.unk_id()
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if library.is_byte(i)}
        self.byte_of = {i: bytes([b]) for b, i in self.byte_ids.items()}
        normal = [i for i in size if not (i in self.control or i == self.unknown or i in self.byte_of)]
        if any(library.is_unused(i) for i in normal) or any(BLANK in self.pieces[i].lstrip(BLANK) for i in normal):
            raise ValueError("needs a vocabulary without unused pieces, whose blanks only begin pieces")
        self.ids = {self.pieces[i]: i for i in normal}
        self.score = {self.pieces[i]: library.get_score(i) for i in normal}
        self.pairs: dict[int, bool] = {}
        self.parts: dict[str, list[int]] = {}
        self.automaton = ahocorasick.Automaton()
        reached = {p: i for p, i in self.ids.items() if len(p) == 1 or self.merged(p) == [p]}
        for p, i in reached.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.whole = reached
        # What is tried after a piece: the next shorter one that begins as it does; -1 where there is none.
        self.shorter = [next((reached[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in reached), -1) if p in reached else -1 for p in self.pieces]
        self.sizes = [len(p) for p in self.pieces]
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        inside = {c for two in self.joined for c in two}
        alone = "".join(re.escape(c) for c in map(chr, range(32)) if c not in inside)
        self.words = re.compile(f"[{alone}]| *[^ {alone}]+| +" if alone else " *[^ ]+| +")
        self.surface = [self.byte_of.get(i) or ("" if i in self.control else UNKNOWN if i == self.unknown else p.replace(BLANK, " ")).encode() for i, p in enumerate(self.pieces)]

    def merged(self, text: str) -> list[str]:
        """A few letters under the rule itself: the pair whose piece has the highest score, the leftmost at a tie."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def bears(self, left: str, right: str) -> bool:
        """Whether two pieces stay as they are beside each other."""
        return self.merged(left + right) == [left, right]

    def _remembered(self, key: int) -> bool:
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        found = self.pairs[key] = self.bears(self.pieces[key >> 32], self.pieces[key & 0xFFFFFFFF])
        return found

    def split(self, word: str) -> list[int]:
        """The pieces of a word, as ids; a letter outside the vocabulary is one of its own, as -1 less its code point."""
        if (whole := self.whole.get(word)) is not None:
            return [whole]
        n, pairs, shorter, sizes = len(word), self.pairs.get, self.shorter, self.sizes
        longest = [-1] * n
        for end, (size, i) in self.automaton.iter(word):
            longest[end - size + 1] = i  # ends come in order, so the last one counts
        failed, dirty = bytearray(n // 8 + 1), False
        found: list[int] = []
        left, at, piece = -1, 0, longest[0]
        while True:
            end = at + (sizes[piece] if piece >= 0 else 1)
            if dirty and failed[end >> 3] >> (end & 7) & 1:
                good = False
            elif not found:
                good = True
            elif left >= 0 and piece >= 0:
                key = left << 32 | piece
                good = pairs(key)
                if good is None:
                    good = self._remembered(key)
            else:
                good = self.bears(chr(-1 - left) if left < 0 else self.pieces[left], word[at:end])
            if good:
                left = piece if piece >= 0 else -1 - ord(word[at])
                found.append(left)
                if end == n:
                    return found
                at, piece = end, longest[end]
                continue
            piece = shorter[piece] if piece >= 0 else -1
            while piece < 0:  # no way on from here: the piece before is too long
                failed[at >> 3] |= 1 << (at & 7)
                dirty = True
                if not found:
                    raise ValueError("the vocabulary leaves a word without pieces")
                last = found.pop()
                left, at = found[-1] if found else -1, at - (sizes[last] if last >= 0 else 1)
                piece = shorter[last] if last >= 0 else -1

    def of_part(self, part: str) -> list[int]:
        found = self.split(part)
        if min(found) >= 0:
            return found
        out: list[int] = []
        for i in found:
            out += [i] if i >= 0 else [self.byte_ids[b] for b in chr(-1 - i).encode()] if self.byte_ids else [self.unknown]
        return out

    def of_word(self, word: str) -> list[int]:
        """The ids of a word, blanks written as blanks. Where two letters stand side by side in no piece, no piece reaches
        over them, so what is between such places is encoded, and remembered, by itself."""
        word = word.replace(" ", BLANK)
        if len(self.parts) >= KEPT_WORDS:
            self.parts.clear()
        out: list[int] = []
        cuts = [] if word[1:].isalpha() else [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in self.joined]
        for a, b in zip([0, *cuts], [*cuts, len(word)], strict=True):
            part = word[a:b]
            ids = self.parts.get(part)
            if ids is None:
                ids = self.of_part(part)
                if len(part) <= LONG_WORD:
                    self.parts[part] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of some ids; control ids have none, and the first piece loses the blank set before the text."""
        first = next((i for i in ids if i not in self.control), None)
        text = b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "docloom-one-by-one")
        return text[1:] if first is not None and first not in self.byte_of and self.pieces[first].startswith(BLANK) else text


class PieceIds:
    """Ids of whole texts, by those of their words."""

    def __init__(self, encoder: PieceEncoder):
        self.encoder = encoder
        self.forget()

    def forget(self) -> None:
        self.index: dict[str | None, int] = {}
        self.start, self.size, self.ids, self.held = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), np.zeros(1 << 14, np.int32), 0
        self.add([None], [[self.encoder.end_id]])  # the end of a text counts as a word

    def add(self, words: list[str | None], ids: list[list[int]]) -> None:
        n, sizes = len(self.index), np.array(list(map(len, ids)), np.int64)
        to, m = n + len(words), self.held + int(sizes.sum())
        if to > len(self.start):
            self.start, self.size = np.resize(self.start, 2 * to), np.resize(self.size, 2 * to)
        if m > len(self.ids):
            self.ids = np.resize(self.ids, 2 * m)
        self.index.update(zip(words, range(n, to), strict=True))
        self.size[n:to] = sizes
        self.start[n:to] = self.held + np.cumsum(sizes) - sizes
        self.ids[self.held : m] = np.fromiter(chain.from_iterable(ids), np.int32, m - self.held)
        self.held = m

    def of(self, texts: list[str], end: bool) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts one after the other, and where each text begins, and the last one ends."""
        if len(self.index) > KEPT_WORDS:
            self.forget()
        words: list[str | None] = []
        ends = [0]
        for t in texts:
            if t:
                words += self.encoder.words.findall(" " + t.replace(BLANK, " "))
            if end:
                words.append(None)
            ends.append(len(words))
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        gaps = np.flatnonzero(at < 0).tolist()
        new = dict.fromkeys(words[i] for i in gaps)
        short, long = [w for w in new if len(w) <= LONG_WORD], [w for w in new if len(w) > LONG_WORD]
        self.add(short, list(map(self.encoder.of_word, short)))
        held = self.held
        self.add(long, list(map(self.encoder.of_word, long)))
        at[gaps] = [self.index[words[i]] for i in gaps]
        ids, stops = _gathered(self.ids, self.start[at], self.size[at])
        for w in long:  # forgotten after their texts
            del self.index[w]
        self.held = held
        return ids, np.append(0, stops)[ends]


@lru_cache(maxsize=2)
def piece_ids(path: str) -> PieceIds:
    """One per worker process and vocabulary."""
    return PieceIds(PieceEncoder(path))


def encode_pieces(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", end: bool = True, decoded: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all but `text`) with `ids`, array<int>: the pieces of each whole text, exactly as the
    library has them without sampling, and the end id after them if `end`. With `decoded`, a column of that name has the
    text that those ids stand for.

    A narrow map, no shuffle. A null or empty text has no pieces; other columns may be null and pass unchanged; repeated
    rows are encoded each; an empty table gives an empty one. Columns of the input named like results are replaced. A text
    of any length is encoded whole, in time and memory that grow with its length. The vocabulary must be at `path` on every
    machine.
    """
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in (text, ids, decoded)]
    fields = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + [f"`{ids}` array<int>"] + ([f"`{decoded}` string"] if decoded else [])

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        own = piece_ids(path)
        flat, starts = own.of([t.decode("utf-8", "replace") for t in utf8(b.column(len(keep)))], end)
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(flat, pa.int32()))
        out = [*b.columns[: len(keep)], lists]
        if decoded:
            out.append(pa.array([own.encoder.decode(flat[a:z].tolist()) for a, z in zip(starts[:-1], starts[1:], strict=True)], pa.string()))
        return pa.RecordBatch.from_arrays(out, [*keep, ids, *([decoded] if decoded else [])])

    source = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`")).toDF(*(f"c{i}" for i in range(len(keep) + 1)))
    return map_batches(source, each, ", ".join(fields))


def decode_pieces(encoded: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """The table with `ids` replaced by the text that they stand for (column `text`; null ids give null). Narrow. Bytes that
    make no character become U+FFFD each; an id outside the vocabulary fails the job."""
    keep = [c for c in encoded.columns if c not in (ids, text)]
    fields = [f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in keep] + [f"`{text}` string"]

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        decode = piece_ids(path).encoder.decode
        texts: Iterator[str | None] = (None if x is None else decode(x) for x in b.column(len(keep)).to_pylist())
        return pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(texts, pa.string())], [*keep, text])

    source = encoded.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{ids}`")).toDF(*(f"c{i}" for i in range(len(keep) + 1)))
    return map_batches(source, each, ", ".join(fields))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = encode_pieces(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), decoded="decoded", keep=["doc_id"])
    as_text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(as_text, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
