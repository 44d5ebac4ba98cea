"""Token ids of whole documents in compressed blocks, written as a table of blocks and read back from it.

The file format is a Parquet table with one row per block in ascending document order: (part, block, before, doc_ids,
n_tokens, payload, crc32). `before` counts the ids of earlier blocks of the part. `payload` is a block of `docloom.llm.rans`; `crc32` is the checksum of the block's ids as little-endian
unsigned 32-bit integers. Blocks hold whole documents and decode by themselves; inside a block checkpoints allow
decoding from the middle. The shared frequency table lies beside them as a second Parquet table (id, freq).
"""

from __future__ import annotations

import os
import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docloom.checkpoints import materialise, shared_dir
from docloom.llm.common import batch, longs, map_batches, read, utf8
from docloom.llm.rans import Coder, Table, scaled
from docloom.llm.token_counts import byte_letters

#: Ids of a block, about; a longer document makes a longer block.
BLOCK_TOKENS = 1 << 20
#: Words whose ids a worker keeps, about; then it begins anew. Bounds memory, not results.
KEPT_WORDS = 400_000

BLOCKS = "part int, block int, before long, doc_ids array<long>, n_tokens array<long>, payload binary, crc32 long"


#: ASCII punctuation without the apostrophe, which begins endings of English words.
_MARKS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
#: Words of small Latin letters that lower-casing and composing leave as they are.
_SMALL = re.compile(f"[{''.join(c for c in map(chr, range(97, 0x250)) if c.isalpha() and c == c.lower() == unicodedata.normalize('NFC', c))}]+")
#: Letters of one text to the library, and bytes of texts worked on at once: longer texts are cut at blanks.
_TOGETHER, _AT_ONCE = 2048, 8 << 20


def _gathered(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of `ids` one after the other, and where each ends."""
    ends = np.cumsum(size)
    places = np.repeat(start - ends + size, size)
    places += np.arange(len(places))
    return ids[places], ends


class WordIds:
    """The ids of texts, by those of their words: words that this worker hasn't seen go to the tokenizers library.

    Right for tokenizers that lower-case, drop white space and have no piece that reaches over ASCII white space, or
    from a letter or digit to punctuation: word_bpe_49k.json.
    """

    def __init__(self, path: str, end_id: int = 0):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        # Small letters are as the normalizer leaves them and one piece: the model alone is enough, on letters that stand for bytes.
        self.plain = Tokenizer(self.library.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = byte_letters() | {32: " "}
        vocabulary = self.library.get_vocab()
        suffix, top = self.library.model.end_of_word_suffix, max(vocabulary.values())
        self.last = np.zeros(top + 1, bool)
        self.last[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.width = 4 if max(end_id, top) >= 1 << 16 else 2
        self.kind = f"<u{self.width}"
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.start, self.size, self.ids = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.zeros(1 << 18, self.kind)
        self.held = 0

    def add(self, words: list[bytes], ids: np.ndarray, size: np.ndarray) -> None:
        n, m = len(self.index), self.held
        while n + len(words) > len(self.start):
            self.start, self.size = np.concatenate([self.start, self.start]), np.concatenate([self.size, self.size])
        while m + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, self.ids])
        self.index.update(zip(words, range(n, n + len(words)), strict=True))
        self.size[n : n + len(words)] = size
        self.start[n : n + len(words)] = m + np.cumsum(size) - size
        self.ids[m : m + len(ids)] = ids
        self.held += len(ids)

    def by_library(self, words: list[bytes]) -> None:
        """Add words as the library has them: small letters many at a time, cut after the tokens that end a word."""
        small = [bool(_SMALL.fullmatch(w.decode("utf-8", "replace"))) for w in words]
        letters = [w for w, x in zip(words, small, strict=True) if x]
        for i in range(0, len(letters), _TOGETHER):
            some = letters[i : i + _TOGETHER]
            ids = np.array(self.plain.encode_batch_fast([b" ".join(some).decode("latin-1").translate(self.letters)], add_special_tokens=False)[0].ids, self.kind)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(some):
                raise ValueError("the vocabulary doesn't mark the ends of words")
            self.add(some, ids, np.diff(ends, prepend=0))
        others = [w for w, x in zip(words, small, strict=True) if not x]
        for i in range(0, len(others), _TOGETHER):
            some = others[i : i + _TOGETHER]
            found = [np.array(e.ids, self.kind) for e in self.library.encode_batch_fast([w.decode("utf-8", "replace") for w in some], add_special_tokens=False)]
            self.add(some, np.concatenate(found), np.array([len(x) for x in found]))

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each of some distinct words; new ones are split off the punctuation after them."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        gaps = np.flatnonzero(at < 0)
        if len(gaps):
            new = [words[i] for i in gaps]
            split = [(w, x, w[len(x) :]) for w, x in zip(new, map(bytes.rstrip, new, repeat(_MARKS))) if w != x and x and (x[-1:].isalnum() or _SMALL.fullmatch(x.decode("utf-8", "replace")))]
            parts = set(new).difference(w for w, _, _ in split).union(x for _, *pair in split for x in pair)
            self.by_library([x for x in parts if x not in self.index])
            split = [x for x in split if x[0] not in self.index]
            pairs = np.array([(self.index[x], self.index[y]) for _, x, y in split], np.int64).reshape(-1, 2)
            ids, _ = _gathered(self.ids, self.start[pairs].ravel(), self.size[pairs].ravel())
            self.add([w for w, _, _ in split], ids, self.size[pairs].sum(1))
            at[gaps] = np.fromiter(map(self.index.__getitem__, new), np.int64, len(new))
        return at

    def of_some(self, texts: list[bytes]) -> list[bytes]:
        if len(self.index) > KEPT_WORDS:
            self.forget()
        # the buffer is read as a string column: split and told apart at ASCII bytes, whatever the others are
        column = pc.ascii_lower(pa.array(texts, pa.binary()).view(pa.string()))
        lists = pc.ascii_split_whitespace(column)
        words = lists.flatten().dictionary_encode()
        place = self.places(words.dictionary.view(pa.binary()).to_pylist())[words.indices.to_numpy()]
        ids, ends = _gathered(self.ids, self.start[place], self.size[place])
        data, cuts = ids.tobytes(), np.append(0, ends)[lists.offsets.to_numpy()] * self.width
        return [data[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def whole(self, text: bytes) -> bytes:
        return np.array(self.library.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)[0].ids, self.kind).tobytes()

    def of(self, texts: list[bytes]) -> list[bytes]:
        """The packed ids of each text. A text with what may be a special string, which knows case, or with an accent
        that only a small letter may take in, goes to the library as it is."""
        out: list[list[bytes]] = [[] for _ in texts]
        owners: list[int] = []
        some: list[bytes] = []
        held = 0

        def done() -> None:
            for i, x in zip(owners, self.of_some(some), strict=True):
                out[i].append(x)
            owners.clear()
            some.clear()

        for i, text in enumerate(texts):
            if b"<|" in text or b"\xcc" in text:
                out[i].append(self.whole(text))
                continue
            at = 0
            while at < len(text):
                blank = _BLANK.search(text, at + _AT_ONCE) if len(text) - at > _AT_ONCE else None
                end = blank.start() if blank else len(text)
                owners.append(i)
                some.append(text[at:end])
                held, at = held + end - at, end
                if held >= _AT_ONCE:
                    done()
                    held = 0
        done()
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]


@lru_cache(maxsize=4)
def word_ids(path: str, end_id: int) -> WordIds:
    return WordIds(path, end_id)


def tokenise(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids as packed 16-bit integers or 32-bit ones, width, n_tokens), with `end_id` after each document."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        cache = word_ids(path, end_id)
        end = np.array([end_id], cache.kind).tobytes()
        packed = [x + end for x in cache.of(utf8(b.column("text")))]
        n = [len(x) // cache.width for x in packed]
        return batch(doc_id=b.column("doc_id"), ids=pa.array(packed, pa.binary()), width=pa.array([cache.width] * len(n), pa.int32()), n_tokens=longs(n))

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(source, each, "doc_id long, ids binary, width int, n_tokens long")


def frequency_table(tokens: DataFrame) -> Table:
    """Counts of every id over all rows, as a scaled table. What reaches the driver is a row per distinct id, so at
    most the vocabulary."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for b in batches:
            for width in b.column("width").unique().to_pylist():
                own = b.column("ids").filter(pc.equal(b.column("width"), width)).to_pylist()
                c = np.bincount(np.frombuffer(b"".join(own), f"<u{width}"))
                if len(c) > len(total):
                    total = np.concatenate([total, np.zeros(len(c) - len(total), np.int64)])
                total[: len(c)] += c
        seen = np.flatnonzero(total)
        yield batch(id=longs(seen), n=longs(total[seen]))

    found = tokens.select("ids", "width").mapInArrow(counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return scaled(found["id"].to_numpy(np.int64), found["n"].to_numpy(np.int64))


def encode_blocks(tokens: DataFrame, table: Table, partitions: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks in ascending order of doc_id (null first; equal ids by their content), one range of ids a partition."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, block = Coder(table), TaskContext.get().partitionId(), 0
        docs, sizes, arrays, held, before = [], [], [], 0, 0

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(arrays)
            return batch(
                part=pa.array([part], pa.int32()),
                block=pa.array([block], pa.int32()),
                before=longs([before]),
                doc_ids=pa.array([docs], pa.list_(pa.int64())),
                n_tokens=pa.array([sizes], pa.list_(pa.int64())),
                payload=pa.array([coder.encode(ids)], pa.binary()),
                crc32=longs([zlib.crc32(ids.astype("<u4").tobytes())]),
            )

        for b in batches:
            for doc, ids, width in zip(b.column("doc_id").to_pylist(), b.column("ids"), b.column("width"), strict=True):
                if docs and held + len(ids.as_buffer()) // width.as_py() > block_tokens:
                    yield closed()
                    block, before = block + 1, before + held
                    docs, sizes, arrays, held = [], [], [], 0
                docs.append(doc)
                arrays.append(np.frombuffer(ids.as_buffer(), f"<u{width.as_py()}").astype(np.int64))
                sizes.append(len(arrays[-1]))
                held += sizes[-1]
        if docs:
            yield closed()

    dealt = tokens.withColumn("tie", F.xxhash64("ids")).repartitionByRange(partitions, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "ids")
    return dealt.select("doc_id", "ids", "width").mapInArrow(each, BLOCKS)


def write_token_blocks(
    docs: DataFrame, at: str, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text", block_tokens: int = BLOCK_TOKENS
) -> None:
    """Write the ids of every document in ascending order of `doc_id` to the tables `at`/blocks and `at`/table.

    Each text is tokenised once; its ids are kept in the shared folder, counted there, and dealt by ranges of
    doc_id into as many files as spark.sql.shuffle.partitions. A null or empty text is a document of `end_id`
    alone; null ids come first; repeated rows are documents of their own; other columns are ignored; an empty
    table makes an empty table of blocks. A long document makes one long block.
    """
    spark = docs.sparkSession
    tokens = materialise(tokenise(docs, path, end_id, doc_id, text), "tokens")
    table = frequency_table(tokens)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    encode_blocks(tokens, table, parts, block_tokens).write.parquet(f"{at}/blocks")
    rows = list(zip(table.ids.tolist(), table.freq.tolist(), strict=True))
    spark.createDataFrame(rows, "id long, freq long").coalesce(1).write.parquet(f"{at}/table")


def read_table(spark: SparkSession, at: str) -> Table:
    found = spark.read.schema("id long, freq long").parquet(f"{at}/table").toPandas().sort_values("id")
    freq = found["freq"].to_numpy(np.int64)
    return Table(found["id"].to_numpy(np.int64), freq, int(freq.sum()).bit_length() - 1 if len(freq) else 1)


def read_token_blocks(spark: SparkSession, at: str) -> DataFrame:
    """Per document, decoded from the blocks: doc_id, start (ids of all documents before it), n_tokens, ids (packed,
    little-endian unsigned 32-bit). A block whose checksum differs fails the job."""
    table = read_table(spark, at)
    blocks = spark.read.schema(BLOCKS).parquet(f"{at}/blocks")
    sizes = blocks.select("part", F.expr("aggregate(n_tokens, 0L, (a, x) -> a + x)").alias("n")).groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row per part, and there are as many parts as shuffle partitions at the time of writing: small enough for
    # one window and for a broadcast.
    offsets = F.broadcast(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))

    def each(coder: Coder, b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for i in range(b.num_rows):
            (row,) = b.slice(i, 1).to_pylist()
            ids = coder.decode(row["payload"]).astype("<u4")
            if zlib.crc32(ids.tobytes()) != row["crc32"]:
                raise ValueError(f"block {row['part']}/{row['block']}: checksum differs")
            ends = np.cumsum(row["n_tokens"])
            cut = [x.tobytes() for x in np.split(ids, ends[:-1])]
            yield batch(
                doc_id=longs(row["doc_ids"]), start=longs(row["offset"] + row["before"] + ends - row["n_tokens"]), n_tokens=longs(row["n_tokens"]), ids=pa.array(cut, pa.binary())
            )

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(table)
        for b in batches:
            yield from each(coder, b)

    return blocks.join(offsets, "part").mapInArrow(flat, "doc_id long, start long, n_tokens long, ids binary")


def with_crc32(decoded: DataFrame) -> DataFrame:
    return decoded.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def encode_and_read(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """Write `docs` in the block format into the shared folder; return the digest read back from it."""
    at = f"{shared_dir(docs.sparkSession)}/token-ids-{uuid.uuid4().hex}"
    write_token_blocks(docs, at, path, end_id)
    return with_crc32(read_token_blocks(docs.sparkSession, at))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_and_read(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2)
