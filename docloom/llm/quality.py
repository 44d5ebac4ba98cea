"""Quality rules: counts within a document, then lines that many documents of a host share."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.checkpoints import materialise
from docloom.llm.common import batch, longs, map_batches, read, utf8

SYMBOLS, BLANKS = b"#*$%&|<>", b" \t\n\r\x0b\f"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more in the text, the first one included."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times, marked = Counter(windows), bytearray(len(words))
    for i, w in enumerate(windows):
        if times[w] > 1:
            marked[i : i + 3] = b"\1\1\1"
    return sum(marked)


def duplicate_lines(text: bytes) -> int:
    r"""\n-split lines that hold a word and equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return len(lines) - len(set(lines))


def document_counts(docs: DataFrame, doc_id: str, host: str, text: str) -> DataFrame:
    """Counts of each document, and its distinct normalised lines as (hash, words on them)."""
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(host).cast("string").alias("host"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("digest"), F.col(text).alias("text")
    )

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        n_words, chars, symbols, dup, rep, lines = [], [], [], [], [], []
        for text in utf8(b.column("text")):
            words = text.split()
            solid = text.translate(None, BLANKS)
            n_words.append(len(words))
            chars.append(len(solid.decode()))
            symbols.append(len(solid) - len(solid.translate(None, SYMBOLS)))
            dup.append(duplicate_lines(text))
            rep.append(repeated_words(words))
            own: Counter[bytes] = Counter()
            for line in text.lower().split(b"\n"):
                if on_it := line.split():
                    own[xxhash.xxh3_128_digest(b" ".join(on_it))] += len(on_it)
            lines.append([{"h": h, "words": n} for h, n in own.items()])
        return batch(
            doc_id=b.column("doc_id"), host=b.column("host"), digest=b.column("digest"), n_words=longs(n_words), word_chars=longs(chars), n_symbols=longs(symbols),
            n_dup_lines=longs(dup), n_repeat_words=longs(rep), lines=pa.array(lines, pa.list_(pa.struct([("h", pa.binary()), ("words", pa.int64())]))),
        )

    return map_batches(
        source, each,
        "doc_id long, host string, digest binary, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, lines array<struct<h: binary, words: long>>",
    )


def quality_rules(
    docs: DataFrame,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    min_docs: int = 10,
    max_share: float = 0.005,
    min_left_share: float = 0.5,
    doc_id: str = "doc_id",
    host: str = "source",
    text: str = "text",
) -> DataFrame:
    """Per document: its counts, base_failed, n_line_words (words on lines above the limit), depleted and kept.

    A line (blanks collapsed, A-Z lowered) is above the limit in a host if it stands in at least `min_docs` distinct
    texts of that host and in more than `max_share` of them; exact copies of a text count once, so that copies alone don't
    condemn their lines. A document is depleted if less than `min_left_share` of its words are left without such lines; it is
    kept if it isn't, and neither is too short nor repeats itself.

    A null text has no words and fails; documents of a null host make a host of their own; null or equal ids are
    kept apart by their text's digest; fully equal rows get equal verdicts, one row each; an empty table gives an
    empty result; other columns are ignored. Line counts are sums over partial counts. The lines above the limit, few, go back
    to their documents by a semi join, which Spark broadcasts while they are small and whose large partitions it splits
    beyond that; per document only its own lines are held.
    """
    counts = materialise(document_counts(docs, doc_id, host, text), "quality")
    lines = counts.select("doc_id", "host", "digest", F.explode("lines").alias("line")).select("doc_id", "host", "digest", "line.h", "line.words")
    texts = counts.select("host", "digest").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("texts"))
    often = lines.select("host", "h", "digest").distinct().groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs)
    often = often.join(texts.withColumnRenamed("host", "t"), F.col("host").eqNullSafe(F.col("t"))).where(F.col("n") > F.col("texts") * max_share)
    often = often.select(F.col("host").alias("o"), F.col("h").alias("g"))
    common = lines.join(often, F.col("host").eqNullSafe(F.col("o")) & (F.col("h") == F.col("g")), "left_semi")
    common = common.distinct().groupBy("doc_id", "host", "digest").agg(F.sum("words").alias("n_line_words"))
    common = common.withColumnsRenamed({"doc_id": "d", "host": "s", "digest": "u"})
    same = F.col("doc_id").eqNullSafe(F.col("d")) & F.col("host").eqNullSafe(F.col("s")) & (F.col("digest") == F.col("u"))
    rows = counts.drop("lines").join(common, same, "left").withColumn("n_line_words", F.coalesce("n_line_words", F.lit(0)))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    depleted = F.col("n_words") - F.col("n_line_words") < F.col("n_words") * min_left_share
    return rows.withColumn("base_failed", failed).withColumn("depleted", depleted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_line_words", "depleted", (~F.col("base_failed") & ~F.col("depleted")).alias("kept"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read(spark, sf_dir, "documents"))


OP10_SQL = r"""
with docs as (
  select doc_id, source as host, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
lines as (
  select doc_id, host, text, unnest(string_split(text, chr(10))) as line from docs),
dups as (
  select doc_id, count(line) - count(distinct line) as n_dup_lines from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
placed as (select doc_id, unnest(words) as w, generate_subscripts(words, 1) as i from docs),
windows as (
  select doc_id, i, w || ' ' || lead(w, 1) over (partition by doc_id order by i) || ' ' || lead(w, 2) over (partition by doc_id order by i) as g from placed),
twice as (select doc_id, i, count(*) over (partition by doc_id, g) as n from windows where g is not null),
repeats as (select doc_id, count(distinct i + k) as n_repeat_words from twice, (values (0), (1), (2)) as v(k) where n > 1 group by doc_id),
keyed as (
  select doc_id, host, text, list_aggregate(regexp_extract_all(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), 'string_agg', ' ') as key,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as n
  from lines where regexp_matches(line, '[^\x20\x09-\x0D]')),
texts as (select host, count(distinct text) as texts from docs group by host),
often as (
  select k.host, k.key from keyed k join texts t on k.host is not distinct from t.host
  group by k.host, k.key having count(distinct k.text) >= 10 and count(distinct k.text) > 0.005 * any_value(t.texts)),
common as (
  select k.doc_id, sum(k.n)::bigint as n_line_words from keyed k join often o on k.host is not distinct from o.host and k.key = o.key group by k.doc_id),
counts as (
  select d.doc_id, len(d.words) as n_words, length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
         length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(u.n_dup_lines, 0) as n_dup_lines, coalesce(r.n_repeat_words, 0) as n_repeat_words, coalesce(c.n_line_words, 0) as n_line_words
  from docs d left join dups u using (doc_id) left join repeats r using (doc_id) left join common c using (doc_id))
select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed,
       n_words - n_line_words < 0.5 * n_words as depleted, not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_words - n_line_words >= 0.5 * n_words as kept
from counts
"""
