"""Line de-duplication by range-partitioned hashes, answered with keep bitmaps.

Each document sends one row per distinct line: (hash of the line's key, document, positions). Rows are dealt by ranges
of (hash, document) and sorted by them, so a line that stands in a third of all documents spreads over many tasks.
Each task streams its rows run by run and holds the rows of fewer than `min_docs` documents at a time. A run that
touches the edge of a partition may go on in the next one: its count goes to a table with two rows per partition,
from which such runs are settled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.checkpoints import materialise
from docloom.llm.common import batch, longs, map_batches, read, utf8

_DROP, _OPEN, _LEAD, _EDGE = range(4)
_MARKS = "part int, kind int, h binary, doc_id long, uid binary, positions array<int>, n long"


def _source(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, uid, text): uid is the text's digest; equal ids with unequal texts are documents of their own."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.unhex(F.md5(whole)).alias("uid"), whole.alias("text"))


def line_hashes(source: DataFrame) -> DataFrame:
    """(h, doc_id, uid, positions): per document one row for each key that isn't empty."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        hashes, rows, positions = [], [], []
        for i, text in enumerate(utf8(b.column("text"))):
            own: dict[bytes, list[int]] = {}
            for k, line in enumerate(text.split(b"\n")):
                if key := line.strip().lower():
                    own.setdefault(key, []).append(k)
            hashes += map(xxhash.xxh3_128_digest, own)
            positions += own.values()
            rows += [i] * len(own)
        at = pa.array(rows, pa.int32())
        return batch(
            h=pa.array(hashes, pa.binary()), doc_id=b.column("doc_id").take(at), uid=b.column("uid").take(at), positions=pa.array(positions, pa.list_(pa.int32()))
        )

    return map_batches(source, each, "h binary, doc_id long, uid binary, positions array<int>")


def _stream(min_docs: int, keep_first: bool):
    """Sorted rows in, marks out: positions to drop, rows that wait for other partitions, counts of edge runs."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        out: list[tuple] = []
        run, docs, doc, held, first_run = None, 0, None, [], True

        def put(kind, h, row, positions, n=None):
            if positions or kind == _EDGE:
                out.append((part, kind, h, *row, positions, n))

        def drop(row, positions, leads):
            if leads and keep_first:
                if first_run:
                    put(_LEAD, run, row, positions)
                else:
                    put(_DROP, run, row, positions[1:])
            else:
                put(_DROP, run, row, positions)

        def end(last: bool):
            """The run is over, or the partition is."""
            if run is None or not (first_run or last):
                return
            put(_EDGE, run, (None, None), None, docs)
            for row, positions, leads in held:
                if leads and keep_first and first_run:
                    put(_LEAD, run, row, positions)
                else:
                    put(_OPEN, run, row, positions[1:] if leads and keep_first else positions)

        def flushed() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True))
            out.clear()
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["part", "kind", "h", "doc_id", "uid", "positions", "n"])

        for b in batches:
            for h, d, uid, positions in zip(*(b.column(c).to_pylist() for c in ("h", "doc_id", "uid", "positions")), strict=True):
                leads = h != run
                if leads:
                    end(False)
                    first_run = run is None
                    run, docs, doc, held = h, 0, None, []
                if not leads and (d, uid) == doc:
                    continue  # a repeated row
                docs, doc = docs + 1, (d, uid)
                if docs < min_docs:
                    held.append(((d, uid), positions, leads))
                else:
                    for x in held:
                        drop(*x)
                    held = []
                    drop((d, uid), positions, leads)
            if len(out) > 20_000:
                yield flushed()
        end(True)
        if out:
            yield flushed()

    return marks


def dropped_positions(hashes: DataFrame, min_docs: int, keep_first: bool = False) -> DataFrame:
    """(doc_id, uid, dropped): the positions of each document's lines to drop, documents without any left out."""
    parts = int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["h", "doc_id", "uid"]
    ranged = hashes.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    marks = materialise(ranged.mapInArrow(_stream(min_docs, keep_first), _MARKS), "line-marks")
    edges = marks.where(F.col("kind") == _EDGE).groupBy("h").agg(F.sum("n").alias("total"), F.min("part").alias("from_part"))
    waiting = marks.where(F.col("kind").isin(_OPEN, _LEAD)).join(edges.where(F.col("total") >= min_docs), "h")
    begins = (F.col("kind") == _LEAD) & (F.col("part") == F.col("from_part"))
    rest = F.slice("positions", F.lit(2), F.size("positions"))
    waiting = waiting.select("doc_id", "uid", F.when(begins, rest).otherwise(F.col("positions")).alias("positions"))
    every = marks.where(F.col("kind") == _DROP).select("doc_id", "uid", "positions").unionAll(waiting)
    return every.groupBy("doc_id", "uid").agg(F.sort_array(F.flatten(F.collect_set("positions"))).alias("dropped"))


def line_keep_bitmaps(docs: DataFrame, min_docs: int = 10, keep_first: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    r"""Per document: doc_id, uid, n_lines, n_dropped, keep (zlib-compressed bits, one a line, first line first).

    Lines are what stands between \n. A line's key is the line without ASCII white space at its ends and with A-Z
    lowered. A key in `min_docs` documents or more is dropped in all of them; with `keep_first` its first line (by
    doc_id, text digest and position) stays. Empty keys are never dropped.

    A null text is one empty line, kept. Null ids sort first and count as one id. Rows equal in id and text are one
    document, with one row here. Empty tables give an empty result; other columns are ignored. A text of any length
    is one row; what is gathered per document is a list of its own lines' positions.
    """
    source = _source(docs, doc_id, text)
    lines = F.length("text") - F.length(F.translate("text", "\n", "")) + 1
    sizes = source.select("doc_id", "uid", lines.cast("long").alias("n_lines")).distinct()
    gone = dropped_positions(line_hashes(source), min_docs, keep_first).select(F.col("doc_id").alias("d"), F.col("uid").alias("u"), "dropped")
    joined = sizes.join(gone, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("uid") == F.col("u")), "left").select("doc_id", "uid", "n_lines", "dropped")

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        keep, counts = [], []
        for n, dropped in zip(b.column("n_lines").to_pylist(), b.column("dropped").to_pylist(), strict=True):
            bits = np.ones(n, np.uint8)
            bits[dropped or []] = 0
            keep.append(zlib.compress(np.packbits(bits).tobytes(), 1))
            counts.append(n - int(bits.sum()))
        return batch(doc_id=b.column("doc_id"), uid=b.column("uid"), n_lines=b.column("n_lines"), n_dropped=longs(counts), keep=pa.array(keep, pa.binary()))

    return map_batches(joined, each, "doc_id long, uid binary, n_lines long, n_dropped long, keep binary")


def keep_lines(text: bytes, n_lines: int, keep: bytes) -> bytes:
    """A text's kept lines, joined by a line feed."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines)
    if bits.all():
        return text
    return b"\n".join(x for x, k in zip(text.split(b"\n"), bits, strict=True) if k)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_lines, n_dropped, text): every row of `docs` with its kept lines."""
    maps = bitmaps.withColumnsRenamed({"doc_id": "d", "uid": "u"})
    source = _source(docs, doc_id, text)
    joined = source.join(maps, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("uid") == F.col("u")))

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        kept = [keep_lines(*x) for x in zip(utf8(b.column("text")), b.column("n_lines").to_pylist(), b.column("keep").to_pylist(), strict=True)]
        return batch(doc_id=b.column("doc_id"), n_lines=b.column("n_lines"), n_dropped=b.column("n_dropped"), text=pa.array([k.decode() for k in kept], pa.string()))

    return map_batches(joined.select("doc_id", "n_lines", "n_dropped", "text", "keep"), each, "doc_id long, n_lines long, n_dropped long, text string")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    kept = apply_bitmaps(docs, line_keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP5_SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
  from documents),
keyed as (
  select *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
often as (select key from keyed where key <> '' group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(*) filter (key in (select key from often)) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (key not in (select key from often)), '')) as kept_sha256
from keyed group by doc_id
"""
