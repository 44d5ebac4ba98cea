"""SentencePiece encoding, fill-in-the-middle and the filter audit against the library, brute force and SQL."""

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import combinations, permutations
from math import factorial

import duckdb
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

import sentencepiece

from docloom.llm import fill_in_middle as fim
from docloom.llm import filter_audit as audit
from docloom.llm import sentencepieces as sps
from tests.llm.test_llm import ODD, SF, table

PIECES = public_tokenizers.path("piece_bpe_32k.model")
MORE = ["▁x ▁", "<s> </s> <unk> <0x41>", " " * 40 + "x" + " " * 17, "a\0b\r\n\tc\n\n d", "１２ ①￾﻿", "日本語" * 3000, "0123456789" * 900, "<P>a", "a<", "<S", "S>b<M>c", "é" * 9000]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_pieces_equal_the_library(spark, library):
    texts = ODD + MORE
    got = {r.doc_id: r for r in sps.encode_pieces(table(spark, texts), PIECES, decoded="back").collect()}
    assert got[0].n == "x" and got[0].size == 7
    for i, t in enumerate(texts):
        want = library.encode(t or "", add_eos=True)
        assert got[i].ids == want, t[:40]
        assert got[i].back == library.decode(want)
    whole = sps.op11_sentencepiece(spark, SF).collect()
    text = {r.doc_id: r.text or "" for r in documents(spark).collect()}
    assert len(whole) == len(text)
    for r in whole:
        ids = library.encode(text[r.doc_id], add_eos=True)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_random_texts_and_ids_equal_the_library(library):
    own, rnd = sps.piece_ids(PIECES), random.Random(3)
    letters = "abcdeéAB  \n\t.,'0123日本🦆\0▁\r-_# tthe"
    texts = ["".join(rnd.choice(own.encoder.pieces[3:]).replace("▁", " ") if rnd.random() < 0.5 else rnd.choice(letters) for _ in range(rnd.choice([1, 4, 30, 150]))) for _ in range(1500)]
    ids, starts = own.of(texts, False)
    assert all(ids[a:b].tolist() == library.encode(t) for t, a, b in zip(texts, starts[:-1], starts[1:], strict=True))
    for _ in range(1500):
        some = [rnd.choice([1, 2, 0, rnd.randrange(3, 259), rnd.randrange(259, 32000), 28705, 259]) for _ in range(rnd.randrange(6))]
        assert own.encoder.decode(some) == library.decode(some)


def test_the_encoder_steps_back_and_remembers_within_bounds(library, monkeypatch):
    own = sps.PieceIds(sps.PieceEncoder(PIECES))
    monkeypatch.setattr(sps, "KEPT_WORDS", 10)
    monkeypatch.setattr(sps, "KEPT_PAIRS", 10)
    rnd = random.Random(1)
    for _ in range(60):
        texts = ["".join(rnd.choice("etaoinshr ") for _ in range(rnd.choice([5, 90, 300]))) for _ in range(5)]
        ids, starts = own.of(texts, True)
        assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:], strict=True)] == library.encode(texts, add_eos=True)
    own.of(["a b c"], True)
    held = own.held
    own.of(["x" * 500_000], True)
    assert own.held <= held  # long words aren't kept
    words = ["▁" + "".join(rnd.choice("etaoinshr") for _ in range(12)) for _ in range(300)]
    longest = lambda w: max((w[:k] for k in range(1, len(w) + 1) if w[:k] in own.encoder.ids), key=len)
    assert any(own.encoder.split(w)[0] != longest(w) for w in words)


def test_pieces_of_nulls_repeats_empty_tables_and_other_names(spark, library):
    rows = spark.createDataFrame([(None, None, "a"), (1, "b c", "d"), (1, "b c", "d")], "c0 long, body string, ids string")
    got = sps.encode_pieces(rows, PIECES, text="body", end=False).collect()
    assert Counter((r.c0, tuple(r.ids)) for r in got) == {(None, ()): 1, (1, tuple(library.encode("b c"))): 2}
    back = sps.decode_pieces(sps.encode_pieces(rows, PIECES, text="body"), PIECES, text="body").collect()
    assert sorted(r.body for r in back) == ["", "b c", "b c"]
    assert sps.encode_pieces(rows.limit(0), PIECES, text="body").count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [1, 2])], "k int, ids array<int>")
    assert {r.k: r.text for r in sps.decode_pieces(nulls, PIECES).collect()} == {1: None, 2: ""}


def rows_of(sql, **tables):
    con = duckdb.connect()
    for name, t in tables.items():
        con.register(name, t) if not isinstance(t, str) else con.execute(f"create view {name} as select * from read_parquet('{t}')")
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    return Counter(tuple(sorted(zip(names, r, strict=True), key=lambda x: x[0])) for r in cursor.fetchall())


def same(df, want):
    assert Counter(tuple(sorted(r.asDict().items())) for r in df.collect()) == want


def cut(text, doc_id):
    n, h = len(text), [int(hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()[i : i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not n or any(m in text for m in fim.MARKS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    x, y, z = text[:a], text[a:b], text[b:]
    return (n, "spm", a, b - a, f"<S>{z}<P>{x}<M>{y}") if h[3] % 100 < 20 else (n, "psm", a, b - a, f"<P>{x}<S>{z}<M>{y}")


def test_fill_in_middle_equals_sql_and_brute_force(spark):
    same(fim.op12_fill_in_middle(spark, SF), rows_of(fim.OP12_SQL, documents=f"{SF}/documents.parquet"))
    rnd = random.Random(7)
    shared = ["".join(rnd.choice("ab é日🦆\n<PSM>") for _ in range(5000)).replace("<P>", "").replace("<S>", "").replace("<M>", "") for _ in range(4)]
    texts = ODD + MORE + ["".join(rnd.sample(shared, 3))[rnd.randrange(300) :] for _ in range(60)] + [shared[0] + "<M>" + shared[1], "x" * 300_000 + "é" * 300_000]
    made = fim.fill_in_middle(table(spark, texts)).withColumn("back", fim.rebuilt(F.col("output"), F.col("form")))
    for r in made.collect():
        text = texts[r.doc_id] or ""
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == cut(text, r.doc_id)
        assert r.back == text


def test_marks_over_borders_of_chunks_are_seen():
    chunks = fim.Chunks(tuple(m.encode() for m in fim.MARKS))
    rnd = random.Random(2)
    for _ in range(40):
        text = bytes(rnd.choice(b"abcdefgh") for _ in range(6000))
        for end in fim.chunk_ends(text)[:-1]:
            for back in (1, 2):
                marked = text[: end - back] + b"<S>" + text[end + 3 - back :]
                assert fim.Layout(marked, chunks).marked
        assert not fim.Layout(text, chunks).marked
    small = fim.Chunks((b"<S>",))
    for text in (b"<S>", b"<", b"", b"<S"):
        assert fim.Layout(text, small).marked == (text == b"<S>")


def test_chunks_follow_the_content():
    rnd = random.Random(4)
    text = bytes(rnd.choice(b"abcdefgh ") for _ in range(60_000))
    own = {text[a:b] for a, b in zip([0, *fim.chunk_ends(text)], fim.chunk_ends(text))}
    moved = b"some other beginning " * 30 + text
    ends = fim.chunk_ends(moved)
    assert len(own & {moved[a:b] for a, b in zip([0, *ends], ends)}) >= 0.8 * len(own) > 20
    ends = fim.chunk_ends(b"a" * 100_000)
    assert ends[-1] == 100_000 and max(b - a for a, b in zip([0, *ends], ends)) <= fim.MOST


def test_chunks_are_kept_within_bounds(monkeypatch):
    monkeypatch.setattr(fim, "KEPT_BYTES", 5000)
    chunks, rnd = fim.Chunks((b"<S>",)), random.Random(6)
    for _ in range(50):
        text = "".join(rnd.choice("aé日 ") for _ in range(4000))
        laid = fim.Layout(text.encode(), chunks)
        assert laid.units == 4000 and all(laid.byte(k) == len(text[:k].encode()) for k in (0, 1, 1999, 3999, 4000))
    assert sum(map(len, chunks.known)) < 5000 + fim.MOST


def test_fill_in_middle_of_nulls_repeats_empty_tables_and_other_names(spark):
    rows = spark.createDataFrame([(None, None, "a"), (None, "b c d", "x"), (1, "b c d", "y"), (1, "b c d", "y")], "id long, body string, form string")
    got = fim.fill_in_middle(rows, doc_id="id", text="body").collect()
    assert Counter((r.id, r.n, r.output) for r in got) == Counter([(None, 0, ""), (None, 5, cut("b c d", "")[4]), *[(1, 5, cut("b c d", 1)[4])] * 2])
    assert fim.fill_in_middle(rows.limit(0), doc_id="id", text="body").count() == 0


def test_coefficients_are_shapley_values():
    for n in (2, 3, 5):
        rows = audit.shapley_coefficients(n)
        rnd = random.Random(n)
        v = [0] + [rnd.randrange(1000) for _ in range((1 << n) - 1)]
        for i in range(n):
            want = sum(
                Fraction(factorial(len(s)) * factorial(n - len(s) - 1)) * (v[sum(1 << j for j in s) | 1 << i] - v[sum(1 << j for j in s)])
                for k in range(n)
                for s in combinations([j for j in range(n) if j != i], k)
            )
            assert sum(a * b for a, b in zip(rows[i], v, strict=True)) == want


def audited(docs, labels):
    """The audit by applying the filters to the documents in every order."""
    fails = {}
    for k, (d, part, text) in enumerate(docs):
        t = text or ""
        words = t.encode().split()
        fails[k] = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": any(c in t for c in "#$%&*|"),
            "E": d is not None and any(o is not None and o < d and (x or "") == t for o, _, x in docs),
        }
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, x in labels if x == 1}
    out, sums = {}, defaultdict(int)
    for order in permutations("ABCDE"):
        alive = {k: docs[k][1] or "" for k in fails}
        for step, f in enumerate(order, 1):
            for part in {p or "" for _, p, _ in docs}:
                own = [k for k in fails if (docs[k][1] or "") == part]
                gone = [k for k in own if k in alive and fails[k][f]]
                sums[part, f] += len(gone)
                out[part, "".join(order), step] = [
                    sum(k in alive for k in own) - len(gone), len(gone), sum(k not in alive and fails[k][f] for k in own), sum(fails[k][f] and sum(fails[k].values()) == 1 for k in own),
                    sum(docs[k][0] in good for k in gone), sum(docs[k][0] in toxic for k in gone),
                ]
            alive = {k: p for k, p in alive.items() if not fails[k][f]}
    return {key: [*x, sums[key[0], key[1][key[2] - 1]]] for key, x in out.items()}


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_equals_sql_and_brute_force(spark):
    got = audit.op13_filter_audit(spark, SF)
    same(got.select(*(F.col(c) for c in got.columns)), rows_of(audit.OP13_SQL, documents=f"{SF}/documents.parquet", labels=f"{SF}/labels.parquet"))
    rnd = random.Random(9)
    base = [None, "", "A B", "word " * 60, " ".join(f"w{i}" for i in range(60)), " ".join(f"W{i}" for i in range(60)), " ".join(f"w{i}#" for i in range(55)), "é" * 30, "日 $"]
    docs = [(rnd.choice([None, *range(25)]), rnd.choice(["a", "b", None, ""]), rnd.choice(base)) for _ in range(40)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in [*range(0, 25, 2), *range(0, 25, 3), None]]
    table_ = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, source string, text string, part string, fails int").repartition(3)
    found = audit.filter_audit(table_, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {(r.part, r.filter_order, r.step): [r[c] for c in COUNTS] for r in found.collect()} == audited(docs, [x for x in labels if x[0] is not None])


def test_audit_of_an_empty_table(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    assert audit.filter_audit(docs.limit(0), labels).count() == 0
    alone = audit.filter_audit(docs, labels.limit(0))
    assert alone.agg(F.sum("good_lost")).first()[0] == 0 and alone.count() == 600 * docs.select("source").distinct().count()


def test_the_pipeline_runs_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    documents(spark).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
