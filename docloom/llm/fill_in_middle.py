"""Fill-in-the-middle documents: prefix, middle and suffix of a text in another order, with marks between them.

Texts are cut into chunks where a rolling hash of their last bytes says so, so that passages shared by texts fall into the
same chunks wherever they stand. What a chunk adds to the count of a text, and what it shows at its ends, is its summary;
a worker remembers the summaries of chunks by their content, and looks into a chunk again only where a cut falls into it.
The summaries, added up, tell a text's length, whether a mark stands in it (also over a border of chunks), and in which
chunks its cuts lie.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Sequence
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.llm.common import longs, map_batches, read, utf8

#: Before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
#: Bytes of a chunk: at least, at most, and on average beyond the least as a power of two. The rolling hash sees 32 bytes.
LEAST, MOST, POWER = 256, 16_384, 10
#: Bytes of chunks that a worker remembers, about; then it begins anew. Bounds memory, not results.
KEPT_BYTES = 32 << 20

_MIX = np.array([int.from_bytes(hashlib.md5(bytes([b])).digest()[:4], "little") for b in range(256)], np.uint32)


def chunk_ends(data: bytes) -> list[int]:
    """Where the chunks of a text end. Only bytes since 32 before a chunk's end, and its beginning, decide on that end."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = _MIX[np.frombuffer(data, np.uint8)]
    for k in (1, 2, 4, 8, 16):  # sums over 2, 4, ... 32 bytes, older ones shifted further
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    ends, start = [], 0
    for c in (np.flatnonzero(h >> np.uint32(32 - POWER) == 0) + 1).tolist():
        while c - start > MOST:
            start += MOST
            ends.append(start)
        if c - start >= LEAST:
            start = c
            ends.append(c)
    while n - start > MOST:
        start += MOST
        ends.append(start)
    return ends if ends and ends[-1] == n else [*ends, n]


class Summary(NamedTuple):
    """Characters that begin in a chunk, whether a mark lies in it, and its first and last bytes."""

    units: int
    marked: bool
    head: bytes
    tail: bytes


class Chunks:
    """Summaries of chunks by content. A dictionary compares contents behind equal hashes, so none is taken for another."""

    def __init__(self, marks: tuple[bytes, ...]):
        self.marks, self.edge = marks, max(map(len, marks)) - 1
        self.known: dict[bytes, Summary] = {}
        self.held = 0

    def __getitem__(self, chunk: bytes) -> Summary:
        found = self.known.get(chunk)
        if found is None:
            if self.held > KEPT_BYTES:
                self.known.clear()
                self.held = 0
            units = int(np.count_nonzero(np.frombuffer(chunk, np.int8) >= -64))  # all but continuation bytes of UTF-8
            found = self.known[chunk] = Summary(units, any(m in chunk for m in self.marks), chunk[: self.edge], chunk[-self.edge :])
            self.held += len(chunk)
        return found


class Layout:
    """A text as chunks: its characters, whether it holds a mark, and where in its bytes a character begins."""

    def __init__(self, data: bytes, chunks: Chunks):
        self.data, self.ends = data, chunk_ends(data)
        self.starts = [0, *self.ends[:-1]]
        parts = [chunks[data[a:b]] for a, b in zip(self.starts, self.ends, strict=bool(self.ends))]
        self.upto = list(accumulate(p.units for p in parts))
        self.units = self.upto[-1] if parts else 0
        self.marked, tail = False, b""
        for p in parts:
            self.marked = self.marked or p.marked or any(m in tail + p.head for m in chunks.marks)
            tail = (tail + p.tail)[-chunks.edge :]

    def byte(self, k: int) -> int:
        """Where character k begins; the text's end for k = units."""
        if k >= self.units:
            return len(self.data)
        i = bisect_right(self.upto, k)
        a = self.starts[i]
        begins = np.flatnonzero(np.frombuffer(self.data[a : self.ends[i]], np.int8) >= -64)
        return a + int(begins[k - (self.upto[i - 1] if i else 0)])


@lru_cache(maxsize=4)
def _chunks(marks: tuple[bytes, ...]) -> Chunks:
    """One per worker process and set of marks."""
    return Chunks(marks)


def fill_in_middle(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: str = "1", plain: int = 10, suffix_first: int = 20, marks: Sequence[str] = MARKS, keep: list[str] | None = None
) -> DataFrame:
    """The columns `keep` (default: all but `text`) with n (characters), form, prefix_chars, middle_chars and output.

    The cuts, and the form, hang on the hash of `seed`, a colon and the document's id alone, so reruns agree: of 100 texts
    about `plain` stay as they are, and `suffix_first` of the others have the suffix first (spm), not the prefix (psm).
    Empty texts, and those that hold a mark, are plain: their counts are null, their output is the text.

    A narrow map, no shuffle. A null text counts as empty, a null id as an empty one. Repeated rows get the same output, an
    empty table gives an empty one. Columns of the input named like results are replaced; others pass unchanged. A text of
    any length is cut whole.
    """
    own = ("n", "form", "prefix_chars", "middle_chars", "output")
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in (text, *own)]
    fields = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + ["n long, form string, prefix_chars long, middle_chars long, output string"])
    p, s, m = (x.encode() for x in marks)

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        chunks, rows = _chunks((p, s, m)), []
        for key, data in zip(utf8(b.column(len(keep))), utf8(b.column(len(keep) + 1)), strict=True):
            laid = Layout(data, chunks)
            digest = hashlib.sha256(f"{seed}:".encode() + key).hexdigest()
            h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
            n = laid.units
            if n == 0 or laid.marked or h3 % 100 >= 100 - plain:
                rows.append((n, "plain", None, None, data))
                continue
            first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
            i, j = laid.byte(first), laid.byte(last)
            head, middle, tail = data[:i], data[i:j], data[j:]
            spm = h4 % 100 < suffix_first
            out = (s, tail, p, head, m, middle) if spm else (p, head, s, tail, m, middle)
            rows.append((n, "spm" if spm else "psm", first, last - first, b"".join(out)))
        n, form, prefix, middle, output = zip(*rows, strict=True) if rows else ((),) * 5
        made = [longs(n), pa.array(form, pa.string()), longs(prefix), longs(middle), pa.array(output, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *made], [*keep, *own])

    source = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{doc_id}`").cast("string"), F.col(f"`{text}`")).toDF(*(f"c{i}" for i in range(len(keep) + 2)))
    return map_batches(source, each, fields)


def rebuilt(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text that an output of this form was made of. Marks are found from the left: none lies in the text, and none
    arises where one meets it, as each begins and ends with a letter that no other place of a mark has."""
    p, s, m = marks
    one, two = F.when(form == "spm", F.lit(s)).otherwise(F.lit(p)), F.when(form == "spm", F.lit(p)).otherwise(F.lit(s))
    at_two, at_middle = F.position(two, output), F.position(F.lit(m), output)
    first = F.substr(output, F.length(one) + 1, at_two - F.length(one) - 1)
    second = F.substr(output, at_two + F.length(two), at_middle - at_two - F.length(two))
    middle = F.substr(output, at_middle + F.lit(len(m)))
    return F.when(form == "plain", output).when(form == "spm", F.concat(second, middle, first)).otherwise(F.concat(first, middle, second))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(rebuilt(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    )


OP12_SQL = """
with h as (
  select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, sha256('1:' || doc_id) as x from documents),
k as (
  select doc_id, t, n, list_transform([1, 9, 17, 25], lambda i: ('0x' || substr(x, i, 8))::ubigint) as h from h),
c as (
  select doc_id, t, n,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h[3] % 100 >= 90 then 'plain' when h[4] % 100 < 20 then 'spm' else 'psm' end as form,
    cast(least(h[1] % (n + 1), h[2] % (n + 1)) as bigint) as a, cast(greatest(h[1] % (n + 1), h[2] % (n + 1)) as bigint) as b from k)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || substr(t, 1, a) || '<S>' || substr(t, b + 1) || '<M>' || substr(t, a + 1, b - a)
         else '<S>' || substr(t, b + 1) || '<P>' || substr(t, 1, a) || '<M>' || substr(t, a + 1, b - a) end) as output_sha256,
  sha256(t) as restored_sha256
from c
"""
