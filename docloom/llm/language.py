"""Language identification by fusing evidence: text, declared markup language, address suffix and host.

Text likelihoods come from hashed byte trigrams, counted per language over a bounded sample of rows whose language is
known. Priors of hosts come from all rows: the text alone votes for a language, votes are counted per host by a grouped
aggregation, and each host's shares are smoothed towards those of its address suffix, and these towards the overall ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.checkpoints import materialise
from docloom.llm.common import batch, longs, map_batches, read, utf8

BUCKETS = 1 << 16
#: Trigrams overlap, so their log-likelihood counts by this share.
TEMPER = 0.2
#: Chance that a declared language, or an address suffix that stands for one, is right.
DECLARED_RIGHT, SUFFIX_RIGHT = 0.9, 0.7
#: Votes that a host's (suffix's) smoothing counts for.
HOST_WEIGHT, SUFFIX_WEIGHT = 10.0, 100.0
RESULTS = ("language", "posterior", "text_language", "accepted")


def trigrams(data: bytes) -> np.ndarray:
    """Buckets of the text's byte trigrams."""
    b = np.frombuffer(b" " + data + b" ", np.uint8).astype(np.uint32)
    return ((((b[:-2] << 16) | (b[1:-1] << 8) | b[2:]) * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def letters(text: bytes) -> bytes:
    """Lower-cased words of the text by single spaces, without digits and ASCII punctuation."""
    return b" ".join(text.decode("utf-8", "replace").lower().encode().translate(None, b"0123456789!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~").split())


def primary(code: Column) -> Column:
    """The language of a code: its first part, lower-cased."""
    return F.lower(F.substring_index(F.substring_index(code.cast("string"), "-", 1), "_", 1))


@dataclass(frozen=True)
class Model:
    """logp: one row per language over the buckets; floor: of text in no language, all buckets alike."""

    languages: list[str]
    logp: np.ndarray

    def score(self, data: bytes) -> tuple[list[float], int]:
        """Log-likelihoods by language against a uniform text, and the number of trigrams."""
        clean = letters(data)
        if not clean:
            return [0.0] * len(self.languages), 0
        total, n = np.zeros(len(self.languages)), 0
        for i in range(0, len(clean), 1 << 20):  # so that a text of any length needs little memory
            t = trigrams(clean[i : i + (1 << 20) + 2])
            total += self.logp[:, t].sum(axis=1, dtype=np.float64)
            n += len(t)
        return (total + n * np.log(BUCKETS)).tolist(), n


def fit(docs: DataFrame, text: str, lang: str, sample: int = 8000, min_docs: int = 5, seed: int = 1, least: int = 500) -> Model:
    """Fit on about `sample` labelled rows, but of each language about `least` (all, if it has no more), chosen by a hash of
    the row, so that copies of one text don't come all together. Languages of fewer than `min_docs` labelled rows in the whole
    table are left out (unless all are). What reaches the driver is a row per language and bucket, and a count per language."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    labelled = {r["l"]: r["n"] for r in known.groupBy(primary(F.col(lang)).alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, enough = sum(labelled.values()), min(min_docs, max(labelled.values(), default=0))
    known = known.where(primary(F.col(lang)).isin([x for x, n in labelled.items() if n >= enough]))
    if total > sample:
        whole = [F.col(f.name) for f in known.schema if f.dataType.simpleString() in ("string", "bigint", "int", "double", "date", "timestamp")]
        at, share = F.pmod(F.xxhash64(F.lit(seed), *whole), F.lit(1 << 40)), sample / total
        limit = F.lit(int((1 << 40) * share))
        # of small languages, whose copies would else decide whether any row is chosen, all rows
        for label in (x for x, n in labelled.items() if n * share < least):
            own = 1.0 if labelled[label] <= 2 * least else least / labelled[label]
            limit = F.when(primary(F.col(lang)) == label, F.lit(int((1 << 40) * max(own, share)))).otherwise(limit)
        known = known.where(at < limit)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for b in batches:
            for label, data in zip(b.column("lang").to_pylist(), utf8(b.column("text")), strict=True):
                own = found.setdefault(label, np.zeros(BUCKETS, np.int64))
                docs_of[label] = docs_of.get(label, 0) + 1
                own += np.bincount(trigrams(letters(data)), minlength=BUCKETS)
        for label, own in found.items():
            seen = np.flatnonzero(own)
            yield batch(lang=pa.array([label] * (len(seen) + 1), pa.string()), bucket=longs([-1, *seen]), n=longs([docs_of[label], *own[seen]]))

    rows = known.select(F.col(text).alias("text"), primary(F.col(lang)).alias("lang")).mapInArrow(counts, "lang string, bucket long, n long")
    table = rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    size = table[table["bucket"] == -1].set_index("lang")["n"].to_dict()
    names = sorted(size)
    logp = np.zeros((len(names), BUCKETS), np.float32)
    for i, name in enumerate(names):
        own = table[(table["lang"] == name) & (table["bucket"] >= 0)]
        n = np.full(BUCKETS, 0.1)
        n[own["bucket"].to_numpy(np.int64)] += own["n"].to_numpy(np.float64)
        logp[i] = np.log(n / n.sum())
    return Model(names, logp)


def text_evidence(docs: DataFrame, model: Model, text: str, keep: list[str]) -> DataFrame:
    """The columns `keep` with __ll (log-likelihood by language, against a uniform text), __n (trigrams). A narrow map."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x 65,536 floats
    names = docs.columns
    schema = f"{', '.join(f'`{c}` {docs.schema[c].dataType.simpleString()}' for c in keep)}, __ll array<double>, __n long"

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [shared.value.score(x) for x in utf8(b.column(names.index(text)))]
        ll, n = pa.array([x for x, _ in found], pa.list_(pa.float64())), longs([n for _, n in found])
        return pa.RecordBatch.from_arrays([*(b.column(names.index(c)) for c in keep), ll, n], [*keep, "__ll", "__n"])

    return map_batches(docs, each, schema)


def host_votes(votes: DataFrame, n: int) -> tuple[DataFrame, list[float]]:
    """((__host, __suffix, __hosts, __suffixes): votes by language of each host and of its suffix, and the shares of all).

    `votes` has host, suffix and vote (the index of the language); counts are summed per key with partial sums first, so
    what is written is a row per host.
    """
    each = F.array(*(F.sum((F.col("vote") == i).cast("long")) for i in range(n)))
    by_host = materialise(votes.groupBy("host", "suffix").agg(each.alias("__hosts")), "votes")
    summed = F.array(*(F.sum(F.col("__hosts")[i]) for i in range(n)))
    per_suffix = by_host.groupBy(F.col("suffix").alias("s")).agg(summed.alias("__suffixes"))
    totals = [x or 0 for x in per_suffix.agg(F.array(*(F.sum(F.col("__suffixes")[i]) for i in range(n))).alias("x")).first()["x"]]
    joined = by_host.join(per_suffix, F.col("suffix").eqNullSafe(F.col("s")))
    # Written, so that Spark knows its size and shuffles texts only where hosts are too many to broadcast.
    table = materialise(joined.select(F.col("host").alias("__host"), F.col("suffix").alias("__suffix"), "__hosts", "__suffixes"), "host-votes")
    return table, [(x + 1.0) / (sum(totals) + n) for x in totals]


def host_prior(base: list[float], vote: Column) -> Column:
    """Shares by language from the host's votes but the row's own, smoothed towards its suffix's and these towards `base`."""
    places = F.array(*map(F.lit, range(len(base))))
    rest = lambda c: F.zip_with(F.coalesce(F.col(c), F.array(*[F.lit(0).cast("long")] * len(base))), places, lambda x, i: x - F.coalesce((i == vote).cast("long"), F.lit(0)))
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, y: a + y)
    hosts, suffixes = rest("__hosts"), rest("__suffixes")
    share = F.zip_with(suffixes, F.array(*map(F.lit, base)), lambda x, p: (x + SUFFIX_WEIGHT * p) / (total(suffixes) + SUFFIX_WEIGHT))
    return F.zip_with(hosts, share, lambda x, p: (x + HOST_WEIGHT * p) / (total(hosts) + HOST_WEIGHT))


def identify(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    declared: Column | None = None,
    suffix: Column | None = None,
    host: Column | None = None,
    min_posterior: float = 0.5,
    min_gain: float = 0.5,
    keep: list[str] | None = None,
) -> DataFrame:
    """`docs`, or its columns `keep`, with language, posterior, text_language and accepted.

    The posterior multiplies the tempered text likelihood, the chances of the declared language and of the suffix
    (where they name a language of the model), and the host's prior, to which its own vote doesn't count. Each text is read
    once; its evidence is written down with the columns to keep. A row is accepted if the best language has at
    least `min_posterior` and the text, where it has 50 trigrams or more, is by at least `min_gain` nats a trigram likelier
    in it than letters at random.

    A declared language (a code of two or three letters) that the model lacks is contradicted by a text that is by
    `min_gain` likelier in a language of the model, where that has `min_posterior`, and by a suffix that stands for another
    language of the model. If nothing contradicts it, it is the row's language, with the chance that declared languages
    are right for posterior, and the row is accepted if its text has letters.

    Empty and null texts give no text evidence: the other evidence decides, and such rows are not accepted. Null
    evidence counts for nothing; null hosts share a prior. Rows and extra columns pass unchanged; columns of the
    input with the names of the four results are replaced. An empty table gives an empty one.
    """
    names, n = model.languages, len(model.languages)
    out = [c for c in (docs.columns if keep is None else keep) if c not in RESULTS]
    none = F.lit(None).cast("string")
    own = [f"c{i}" for i in range(len(out))]
    ready = docs.select(
        *(F.col(f"`{c}`").alias(x) for c, x in zip(out, own, strict=True)), F.col(text).alias("__text"), (none if declared is None else primary(declared)).alias("__declared"), (none if suffix is None else primary(suffix)).alias("__sfx"),
        (none if host is None else host.cast("string")).alias("__h"),
    )
    if not n:
        return ready.select(*own, none.alias("language"), F.lit(0.0).alias("posterior"), none.alias("text_language"), F.lit(False).alias("accepted")).toDF(*out, *RESULTS)
    known = F.array(*(F.lit(x) for x in names))
    best = F.array_position("__ll", F.array_max("__ll")).cast("int") - 1
    evidence = text_evidence(ready, model, "__text", [*own, "__declared", "__sfx", "__h"])
    evidence = materialise(evidence.withColumn("__vote", F.when(F.col("__n") > 0, best)), "evidence")
    votes, base = host_votes(evidence.where("__vote is not null").select(F.col("__h").alias("host"), F.col("__sfx").alias("suffix"), F.col("__vote").alias("vote")), n)
    seen = evidence.join(votes, F.col("__h").eqNullSafe(F.col("__host")) & F.col("__sfx").eqNullSafe(F.col("__suffix")), "left")
    seen = seen.withColumn("__prior", host_prior(base, F.col("__vote")))
    other = lambda right: (1.0 - right) / max(n - 1, 1)

    def named(c: str, right: float, name: str) -> Column:
        return F.when(F.array_contains(known, F.col(c)), F.when(F.col(c) == name, F.log(F.lit(right))).otherwise(F.log(F.lit(other(right))))).otherwise(F.lit(0.0))

    logs = F.array(
        *(
            F.col("__ll")[i] * TEMPER + named("__declared", DECLARED_RIGHT, x) + named("__sfx", SUFFIX_RIGHT, x) + F.log(F.col("__prior")[i])
            for i, x in enumerate(names)
        )
    )
    scored = seen.withColumn("__log", logs).withColumn("__top", F.array_max("__log"))
    scored = scored.withColumn("__sum", F.aggregate("__log", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("__top"))))
    at = F.array_position("__log", F.col("__top")).cast("int")
    scored = scored.withColumn("language", F.element_at(known, at)).withColumn("posterior", 1.0 / F.col("__sum"))
    scored = scored.withColumn("text_language", F.element_at(known, F.col("__vote") + 1))
    gain = F.element_at("__ll", at) / F.greatest("__n", F.lit(1))
    fits = (F.col("__n") > 0) & ((F.col("__n") < 50) | (gain >= min_gain))
    accepted = F.when(fits, F.col("posterior") >= min_posterior).otherwise(False)
    code, contrary = F.col("__declared"), (gain >= min_gain) & (F.col("posterior") >= min_posterior) | F.coalesce(F.array_contains(known, F.col("__sfx")), F.lit(False))
    alone = F.coalesce(code.rlike("^[a-z]{2,3}$") & ~F.array_contains(known, code) & (F.col("__n") > 0) & ~contrary, F.lit(False))
    return scored.select(
        *own, F.when(alone, code).otherwise(F.col("language")).alias("language"), F.when(alone, F.lit(DECLARED_RIGHT)).otherwise(F.col("posterior")).alias("posterior"),
        "text_language", (alone | accepted).alias("accepted"),
    ).toDF(*out, *RESULTS)


def identify_documents(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Documents: their `lang` is the declared language, their `source` the host; they have no address."""
    return identify(docs, fit(docs, "text", "lang"), declared=F.col("lang"), host=F.col("source"), keep=keep)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return identify_documents(docs, ["doc_id"]).select("doc_id", "language", F.round("posterior", 6).alias("posterior"), "text_language", "accepted")


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for web pages: the html element's lang, the address (a country suffix, or the first part of the
    path that names a language) and the host; the text is the page without markup."""
    pages = read(spark, sf_dir, "pages")
    bare = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"(?s)<[^>]*>", " ")
    host = F.regexp_extract("url", r"^[a-z]+://([^/:?#]+)", 1)
    part = F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]{2})(?:[/?#]|$)", 1)
    ready = pages.select(
        "page_id", bare.alias("text"), F.nullif(F.regexp_extract("html", r"(?is)<html[^>]*\blang=[\"']?([a-z]{2})", 1), F.lit("")).alias("declared"),
        F.when(part != "", part).otherwise(F.element_at(F.split(host, r"\."), -1)).alias("suffix"), host.alias("host"),
    )
    found = identify(ready, fit(ready, "text", "declared"), declared=F.col("declared"), suffix=F.col("suffix"), host=F.col("host"), keep=["page_id"])
    return found.select("page_id", "language", F.round("posterior", 6).alias("posterior"), "text_language", "accepted")
