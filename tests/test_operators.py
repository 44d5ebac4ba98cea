"""Branches that the tables don't reach: hand-written rows, sequential brute force, and properties."""

import random

import pytest
from pyspark.sql import functions as F

from docloom.functions import json, paths, trees
from docloom.operators import dedupe, filters, layout, lookup, rewrite, sinks
from docloom.plans import jobs
from docloom.sources import catalogs, files, nested
from docloom.streaming import messages


def one(spark, column, **values):
    """The value of a column expression over one row of texts and numbers."""
    row = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return row.select(column.alias("x")).first()["x"]


def texts(spark, values, name="content"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"path int, {name} string").withColumn("path", F.concat(F.lit("d/"), "path", F.lit(".json")))


def test_json_validity(spark):
    cases = {
        '{"a":1}': True, '{"a":1}x': False, "": False, "Asset": False, '{"a":1,}': False, "[1,2]": True, "1],[2": False, '1},{"w":2': False, '{"a":1,"a":2}': True, '"x"': True, "null": True, None: None,
    }
    df = texts(spark, list(cases))
    assert {r.content: r.v for r in df.select("content", json.is_json(F.col("content")).alias("v")).collect()} == cases


def test_parse_and_reject(spark):
    good, bad = files.parse_objects(texts(spark, ['{"a":null,"b":"\\u00e9"}', "[1]", "x", None]))
    assert [dict(r.fields) for r in good.collect()] == [{"a": None, "b": "é"}]
    assert sorted(r.reason for r in bad.collect()) == ["no text", "not JSON", "not an object"]
    assert one(spark, json.has_key(F.col("t"), "a"), t='{"a":null}') is True
    assert one(spark, json.has_key(F.col("t"), "a"), t="x") is False
    assert one(spark, json.body(F.col("t")), t='x {"a":1} y') == '{"a":1}'
    assert one(spark, json.body(F.col("t")), t="} {") is None


def test_paths(spark):
    assert one(spark, paths.directory(F.col("p")), p="a.json") == ""
    assert one(spark, paths.stem(F.col("p")), p="a/b.c.json") == "b.c"
    assert one(spark, paths.suffix(F.col("p")), p="a/.hidden") == ""
    assert one(spark, paths.inside(F.col("p"), "a/b"), p="a/bc/d") is False


def test_scan_files(spark, tmp_path):
    for p, t in {"a.json": "1", "x/b.json": "2", ".git/c.json": "3", "x/d.txt": "4"}.items():
        (tmp_path / p).parent.mkdir(exist_ok=True)
        (tmp_path / p).write_text(t)
    found = files.scan_files(spark, str(tmp_path), [".json"], exclude_dirs=["x"])
    assert [(r.path, r.content) for r in found.collect()] == [("a.json", "1")]


def test_decode(spark):
    df = spark.createDataFrame([(bytearray(b"\xef\xbb\xbfa\xffb"),)], "content binary")
    assert files.decode_text(df, errors="ignore").first().content == "ab"


def test_flatten_roots(spark):
    docs = texts(spark, ['{"ObjectStates":[{"n":1,"ContainedObjects":[{"n":2},{"n":3}]}]}', '[{"n":4}]', '{"n":5}', '{"ContainedObjects":[{"n":6}]}', "broken {"])
    flat = nested.flatten_objects(docs, "path", "content")
    got = flat.select("path", "ord_path", F.try_variant_get("object", "$.n", "int").alias("n")).orderBy("path", "ord_path").collect()
    assert [(r.n, r.ord_path) for r in got] == [(1, [0]), (2, [0, 0]), (3, [0, 1]), (4, [0]), (5, [0]), (6, [0])]


def rewritten(spark, column, text):
    return one(spark, column, t=text)


def test_leaves(spark):
    docs = texts(spark, ['{"pos":[1.23456,{"x":2.0}],"rot":{"y":-3},"e":[],"o":{},"n":null,"i":7}'])
    leaves = nested.json_leaves(docs.withColumnRenamed("path", "doc"), "doc", "content")
    assert {"/".join(r.path) for r in leaves.collect()} == {"pos/[0]", "pos/[1]/x", "rot/y", "e", "o", "n", "i"}


def test_rounding_by_the_direct_key(spark):
    cases = {
        '{"rot":{"x":44.2,"y":7.5,"z":-8,"s":"44.2","q":{"a":1.23456}}}': '{"rot":{"x":45,"y":0,"z":345,"s":"44.2","q":{"a":1.23456}}}',
        '{"rot":[44.23456,{"x":44.2}],"i":7,"f":2.0}': '{"rot":[44.2346,{"x":45}],"i":7,"f":2}',
        '{"pos":{"x":1.23456,"in":{"x":1.23456},"n":3}}': '{"pos":{"x":1.2346,"in":{"x":1.23456},"n":3}}', "1.23456": "1.2346", "[]": "[]", "broken {": None,
    }
    for text, want in cases.items():
        assert rewritten(spark, rewrite.round_state(F.col("t")), text) == want


def test_dropping_keys_keeps_emptied_containers(spark):
    cases = {
        '{"k":5}': "{}", '{"a":{"k":1},"b":2}': '{"a":{},"b":2}', '{"l":[{"k":1},{"z":1}]}': '{"l":[{},{"z":1}]}', '{"[0]":1,"k":2}': '{"[0]":1}', '[[{"k":[]}],"k"]': '[[{}],"k"]', "x": None,
    }
    for text, want in cases.items():
        assert rewritten(spark, rewrite.drop_keys(F.col("t"), ["k"]), text) == want
    assert one(spark, rewrite.drop_keys(F.lit(None).cast("string"), ["k"])) is None


def test_defaults(spark):
    rules = trees.Defaults({**dict.fromkeys("abcd", False), "Transform": {"a": False}, "CustomMesh": {"Convex": True}, "ColorDiffuse": {"r": 0.7, "g": 0.7, "b": 0.7}}, frozenset({"common"}))
    cases = {
        '{"a":0,"b":false,"c":0.0,"d":"0","AttachedDecals":{"a":0},"x":{"a":0},"l":[{"a":0},0]}': '{"d":"0","AttachedDecals":{"a":0},"x":{},"l":[{},0]}',
        '{"Transform":{"a":false,"q":1}}': '{"Transform":{"a":false,"q":1}}', '{"Transform":{"a":0}}': "{}",
        '{"CustomMesh":{"Convex":true}}': "{}", '{"CustomMesh":{"Convex":true,"u":"v"}}': '{"CustomMesh":{"u":"v"}}',
        '{"Name":"Card","ColorDiffuse":{"r":0.75,"g":0.7,"b":0.7}}': '{"Name":"Card"}', '{"ColorDiffuse":{"r":0.75,"g":0.7,"b":0.7}}': '{"ColorDiffuse":{"r":0.75,"g":0.7,"b":0.7}}',
        '{"CustomDeck":{"1":{"BackURL":"common","UniqueBack":true},"2":{"NumWidth":1,"NumHeight":1},"3":{"NumWidth":2,"UniqueBack":false}}}': '{"CustomDeck":{"1":{"BackURL":"common"},"2":{"NumWidth":1,"NumHeight":1,"UniqueBack":true},"3":{"NumWidth":2}}}',
        '{"Name":"Card","CardID":100,"HideWhenFaceDown":true,"CustomDeck":{"1":{"BackURL":"common"}}}': '{"Name":"Card","CardID":100,"CustomDeck":{"1":{"BackURL":"common"}}}',
        '{"Name":"Card","CardID":100,"HideWhenFaceDown":false,"CustomDeck":{"1":{"BackURL":"common"}}}': '{"Name":"Card","CardID":100,"HideWhenFaceDown":false,"CustomDeck":{"1":{"BackURL":"common"}}}',
        '{"Name":"Deck","HideWhenFaceDown":true}': '{"Name":"Deck"}', '{"Name":"Custom_Tile","CustomImage":{"ImageURL":"u","ImageSecondaryURL":"u"}}': '{"Name":"Custom_Tile","CustomImage":{"ImageURL":"u"}}',
    }
    for text, want in cases.items():
        got = rewritten(spark, rewrite.prune_defaults(F.col("t"), F.lit(False), rules), text)
        assert (got.content, got.changed) == (want, text != want)
    plain = trees.Defaults({})
    text = '{"Transform":{"posX":1,"rotX":3,"rotY":352.5,"rotZ":12.5,"scaleX":1},"o":{"Transform":{"rotY":-3}}}'
    assert rewritten(spark, rewrite.prune_defaults(F.col("t"), F.lit(True), plain)["content"], text) == '{"Transform":{"rotZ":15,"scaleX":1},"o":{"Transform":{}}}'
    assert rewritten(spark, rewrite.prune_defaults(F.col("t"), F.lit(False), plain)["content"], text) == text.replace('{"rotY":-3}', "{}")


def test_rewrites_leave_all_else_as_it_is_written(spark):
    text = '{ "half" : "\\ud800" ,"e":1e400, "l":0.1234567890123456789012345, "deep":' + "[" * 3000 + "]" * 3000 + ',"k": {"k":[1]} , "z":-0.0,"n":NaN}'
    assert rewritten(spark, rewrite.drop_keys(F.col("t"), ["k"]), text) == text.replace(',"k": {"k":[1]}', "")
    got = rewritten(spark, rewrite.prune_defaults(F.col("t"), F.lit(False), trees.Defaults({"k": {"k": [True]}})), text)
    assert (got.content, got.changed) == (text.replace(',"k": {"k":[1]}', ""), True)
    assert rewritten(spark, rewrite.round_state(F.col("t")), text) == text.replace("0.1234567890123456789012345", "0.1235").replace("-0.0", "0")
    for broken in ("", " ", "{,}", '{"a":1,}', "[1,]", "[1 2]", '{"a" 1}', '{"a":}', "{}{}", "01", "1.", "\ufeff{}", '{"a":"\n"}', "[" * 100, "nul", '"\\x"', "+1", "{1:2}"):
        for rule in (rewrite.drop_keys(F.col("t"), ["k"]), rewrite.round_state(F.col("t")), rewrite.prune_defaults(F.col("t"), F.lit(False), trees.Defaults({}))["content"]):
            assert rewritten(spark, rule, broken) is None, broken


def test_rewrites_equal_rules_on_parsed_values():
    """Cuts and replaced places give the values that the rules give on parsed documents, for random documents."""
    import json
    import random

    from docloom.functions import spans

    rnd = random.Random(11)

    def some(depth):
        if depth == 0 or rnd.random() < 0.3:
            return rnd.choice([0, 1, True, False, None, 1.0, 2.345678, -8, "", "u", 'q"\\\n', [], {}])
        if rnd.random() < 0.3:
            return [some(depth - 1) for _ in range(rnd.randrange(4))]
        return {rnd.choice(["a", "b", "rot", "pos", 'c"', "é", "x"]): some(depth - 1) for _ in range(rnd.randrange(6))}

    def dropped(x):
        return [dropped(y) for y in x] if isinstance(x, list) else {k: dropped(y) for k, y in x.items() if k not in gone} if isinstance(x, dict) else x

    def slim(x):
        if not isinstance(x, dict):
            return x
        kept = {k: y for k, y in x.items() if k not in defaults or y != defaults[k]}
        return {k: y if k in defaults else [slim(z) for z in y] if isinstance(y, list) else slim(y) for k, y in kept.items()}

    gone, defaults = frozenset({"a", 'c"'}), {"a": False, "é": {"x": 1}, "b": []}
    drop, prune = spans.Scanner(trees.DropKeys(gone)), spans.Scanner(trees.Minimal(trees.Defaults(defaults), False))
    for _ in range(4000):
        value = some(5)
        text = json.dumps(value, ensure_ascii=rnd.random() < 0.5, indent=rnd.choice([None, 1]))
        assert json.loads(spans.rewritten(text, drop)[0]) == dropped(value)
        content, changed = spans.rewritten(text, prune)
        assert json.loads(content) == slim(value) and changed == (slim(value) != value)


def test_small_rewrites(spark):
    for angle, want in ((-3.0, None), (352.5, None), (357.5, None), (12.4, None), (12.5, 15), (347.4, 345)):
        assert one(spark, rewrite.prune_nested_rotation(F.col("a")), a=angle) == want
    assert one(spark, rewrite.fix_card_id(F.col("k"), F.col("c")), k="123", c=5) == 12305
    assert one(spark, rewrite.fix_card_id(F.col("k"), F.col("c"), pad=False), k="123", c=5) == 1235
    assert one(spark, rewrite.bump_id(F.col("t")), t="01234.a") == "01734.a"
    assert one(spark, rewrite.bump_id(F.col("t")), t="01500") == "01500"
    assert one(spark, rewrite.bump_id(F.col("t")), t="name") == "name"
    assert one(spark, rewrite.retarget_path(F.col("p"), F.lit("abcdef")), p="A.111111/B.222222.json") == "A.111111/B.abcdef.json"
    assert one(spark, rewrite.retarget_path(F.col("p"), F.lit("abcdef")), p="plain.json") == "plain.json"
    assert one(spark, filters.is_object_folder(F.col("n")), n="a.b.c") is False


def test_sort_keys_is_idempotent(spark):
    once = one(spark, rewrite.sort_keys(F.col("t")), t='{"b":{"d":1,"c":[{"z":1,"y":2}]},"a":"x"}')
    assert once == '{"a":"x","b":{"c":[{"y":2,"z":1}],"d":1}}' == one(spark, rewrite.sort_keys(F.col("t")), t=once)


def test_guids_avoid_clashes(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") < 1500, F.left(F.md5(F.concat((F.col("id") + 1500).cast("string"), F.lit("#0"))), F.lit(6))).alias("guid"))
    new = rewrite.assign_guids(df, "id", "guid")
    assert new.count() == 1500 == new.select("guid").distinct().count()
    assert rewrite.assign_guids(df.limit(0), "id", "guid").count() == 0
    with pytest.raises(ValueError):
        rewrite.assign_guids(df, "id", "guid", digits=1, rounds=3)


def test_embedded_ids_in_one_pass(spark):
    records = spark.createDataFrame([("1", "00001 and 00002, 00001", None), ("2", "no ids 123", "x00002"), ("3", "00003", "00009")], "code string, a string, b string")
    ids = spark.createDataFrame([("00001", "00002"), ("00002", "00003"), ("00003", "00003")], "old string, new string")
    got = {(r.code, r.field): r.new_text for r in rewrite.rewrite_embedded_ids(records, ids, ["a", "b"]).collect()}
    assert got == {("1", "a"): "00002 and 00003, 00002", ("2", "b"): "x00003"}


def test_mapping_sheet(spark):
    sheet = spark.createDataFrame([(0, " 1 ", "n", None, "t", '{"a":1,}'), (1, "2", "n", "", "t", '{"a":2}'), (2, "3", "m", "d", "t", "bad")], "row int, id string, name string, description string, type string, metadata string")
    good, bad = catalogs.read_mapping_sheet(sheet)
    assert [(r.name, r.description, r.id) for r in good.collect()] == [("n", "", "2")]
    assert [r.sheet_row for r in bad.collect()] == [4]


def canonical(items):
    own, ids = {}, []
    for key, *fp in items:
        fp = tuple(fp)
        if fp not in own:
            own[fp] = key if key not in own.values() else max(own.values()) + 1
        ids.append(own[fp])
    return ids


def test_canonical_ids_equal_the_sequential_rule(spark):
    rnd = random.Random(2)
    decks = {c: [(rnd.randrange(1, 6), f"f{rnd.randrange(6)}", f"b{rnd.randrange(2)}") for _ in range(12)] for c in range(20)}
    rows = [(c, i, str(k), f, b, i) for c, items in decks.items() for i, (k, f, b) in enumerate(items)]
    got = dedupe.canonical_deck_ids(spark.createDataFrame(rows, "container_id int, pos int, deck_key string, face_url string, back_url string, card_id int"))
    for c, items in decks.items():
        assert [r.new_key for r in got.where(f"container_id = {c}").orderBy("pos").collect()] == canonical(items)


def test_embedded_ids_leftmost_longest_by_automaton_and_by_join(spark):
    rnd = random.Random(8)
    ids = {"".join(rnd.choice("01a") for _ in range(rnd.randrange(1, 6))): f"<{i}>" for i in range(25)}
    texts_ = ["".join(rnd.choice("01ab-") for _ in range(rnd.randrange(0, 40))) for _ in range(60)] + [None, "", "0" * 50]

    def brute(text):
        out, i = "", 0
        while i < len(text):
            hit = max((o for o in ids if text.startswith(o, i)), key=len, default="")
            out, i = out + (ids[hit] if hit else text[i]), i + (len(hit) or 1)
        return out

    records = spark.createDataFrame([(str(i), t, "0") for i, t in enumerate(texts_)], "code string, a string, b string")
    table = spark.createDataFrame([*ids.items(), ("", "x"), (None, "y"), ("zz", None)], "old string, new string")
    want = {(str(i), "a", t, brute(t)) for i, t in enumerate(texts_) if t and brute(t) != t} | {(str(i), "b", "0", brute("0")) for i in range(len(texts_)) if brute("0") != "0"}
    for limit in (rewrite.MAP_BYTES, 0):
        assert {tuple(r) for r in rewrite.rewrite_embedded_ids(records, table, ["a", "b"], map_bytes=limit).collect()} == want
        assert rewrite.rewrite_embedded_ids(records, table.where("old = 'nothing'"), ["a"], map_bytes=limit).count() == 0


def sequential_ids(cards):
    owner, out = {}, []
    for _, k, f, b, _ in cards:
        x = int(k)
        while owner.setdefault(x, (f, b)) != (f, b):
            x += 1
        out.append(x)
    return out


@pytest.mark.parametrize(("seed", "keys", "faces", "head"), [(0, 40, 30, 100_000), (1, 40, 30, 5), (2, 6, 90, 1), (3, 3, 40, 1), (4, 200, 60, 3)])
def test_global_ids_equal_the_sequential_rule(spark, seed, keys, faces, head):
    """Sparse and dense runs, heads read whole, in part and again, and rests by ranks."""
    rnd = random.Random(seed)
    key = lambda i: 9 if seed == 2 and i > 100 and rnd.random() < 0.2 else rnd.randrange(1, keys + 1)  # noqa: E731 (a key that comes late)
    cards = [(i, str(key(i)), f"f{rnd.randrange(faces)}", "b", i) for i in range(160)]
    want = sequential_ids(cards)
    df = spark.createDataFrame(cards, "ord int, deck_key string, face_url string, back_url string, card_id int").repartition(3)
    got = dedupe.global_deck_ids(df, head).orderBy("ord").collect()
    assert [r.new_key for r in got] == want
    assert [r.new_card_id for r in got] == [i if str(k) == old else int(f"{k}{i % 100:02}") for (i, old, *_), k in zip(cards, want, strict=True)]
    assert dedupe.global_deck_ids(df.limit(0), head).count() == 0


def test_survivors_and_manifest_are_all_files(spark):
    all_files = texts(spark, ["x"] * 9).unionAll(texts(spark, ["y"] * 3).withColumn("path", F.replace("path", F.lit(".json"), F.lit(".gmnotes"))))
    left, gone = sinks.delete_manifest(all_files, all_files.where("path in ('d/1.json', 'd/7.json')"))
    assert left.count() + gone.count() == all_files.count()
    assert sorted(r.path for r in gone.collect()) == ["d/1.gmnotes", "d/1.json", "d/7.json"]


def test_first_seen_keeps_rows_without_key(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 3), (None, 4), ("", 5), ("", 6)], "k string, o int")
    assert sorted(r.o for r in dedupe.first_seen(df, ["k"], ["o"]).collect()) == [1, 3, 4, 5, 6]


def test_two_pass_takes_names_in_brackets(spark):
    objects = spark.createDataFrame([(1, 1, "n (d)", ""), (2, 2, "n", "other"), (3, 3, "n", "more")], "obj_id int, ord int, nickname string, description string")
    mapping = spark.createDataFrame([("n", "d", "A"), ("n", "", "B"), ("n", "e", "C")], "name string, description string, id string")
    hit, unused = lookup.match_metadata_two_pass(objects, mapping)
    assert sorted((r.obj_id, r.id) for r in hit.collect()) == [(1, "A"), (2, "C")]
    assert unused.count() == 0


def test_layout_of_one_box_and_no_gap(spark):
    rows = spark.createDataFrame([(1, 0, 0.5, 0.1, 1.0, 1.0), (2, 0, 0.5, 0.1, 1.0, 1.0), (2, 0, 0.5, 0.1, 1.0, 1.0), (2, 0, 0.9, 0.1, 1.0, 1.0)], "image_id int, row int, x double, z double, w_px double, h_px double")
    assert layout.prune_tails(rows).count() == 4 - 1 or layout.prune_tails(rows).count() == 4


def throttled(times, gap):
    out, last = [], None
    for t in sorted(times):
        if last is None or t - last > gap:
            out.append(t)
            last = t
    return out


def test_throttle_stream_equals_table(spark, tmp_path):
    rnd = random.Random(4)
    events = [(f"e{rnd.randrange(3)}", 1_700_000_000 + rnd.randrange(400)) for _ in range(200)]
    df = spark.createDataFrame(events, "body string, s long").select("body", F.timestamp_seconds("s").alias("ts")).dropDuplicates()
    df.repartition(1).write.parquet(f"{tmp_path}/in")
    batch = sorted((r.body, r.ts) for r in messages.throttle_errors(df, 10).collect())
    stream = messages.throttle_error_stream(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), 10)
    q = stream.writeStream.format("memory").queryName("throttled").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.body, r.ts) for r in spark.table("throttled").collect()) == batch
    for body in ("e0", "e1", "e2"):
        want = throttled({s for b, s in events if b == body}, 10)
        assert [t.timestamp() for b, t in batch if b == body] == want


def test_message_stream_is_routed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text('{"messageID":3,"error":"x"}\nbroken\n{"messageID":9}\n{"messageID":2,"message":"hi"}\n')
    good, bad = messages.read_messages(spark.readStream.text(str(tmp_path / "in")))
    routed = messages.route_messages(good, "messageID").select("route")
    q = routed.writeStream.format("memory").queryName("routed").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.route for r in spark.table("routed").collect()) == ["error", "print"]
    assert bad.isStreaming


def test_clean_decks_keeps_every_member(spark):
    members = spark.createDataFrame([(1, i, i % 3) for i in range(6)], "container_id int, pos int, obj_id int")
    objects = spark.createDataFrame([(k, "100", f"f{k}", "b", 10000 + k, f"p{k}") for k in range(3)], "obj_id int, deck_key string, face_url string, back_url string, card_id int, path string")
    assert jobs.clean_decks(members, objects).count() == 6


def test_throttling_one_text_that_never_pauses(spark):
    """A text whose times form one chain, others of single times, nulls and repeats: as the rule has it, one after the other."""
    rnd = random.Random(12)
    t, events = 0, [(None, 5), ("x", None), ("", 7), ("", 7), (None, 5)]
    for _ in range(700):
        t += rnd.choice([1, 3, 4, 9, 10, 11, 2])
        events.append(("hot", t))
    events += [(rnd.choice("ab"), rnd.randrange(400)) for _ in range(150)]
    rnd.shuffle(events)
    df = spark.createDataFrame(events, "body string, s int").select("body", F.timestamp_seconds("s").alias("ts")).repartition(5)
    got = {}
    for r in messages.throttle_errors(df, 10).select("body", F.unix_seconds("ts").alias("s")).collect():
        got.setdefault(r.body, []).append(r.s)
    bodies = {b for b, s in events if s is not None}
    assert {b: sorted(x) for b, x in got.items()} == {b: throttled({s for x, s in events if x == b and s is not None}, 10) for b in bodies}
    assert messages.throttle_errors(df.limit(0), 10).count() == 0


def test_console_stream_equals_table(spark, tmp_path):
    """Scripts, errors and the rest through one stateful operator, over files that come late, with a restart between them."""
    import json

    rnd = random.Random(3)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def message(k, at):
        kind = rnd.choice([0, 1, 1, 2, 3, 3, 3, 5, 9])
        states = [{"guid": str(rnd.randrange(3)), "script": f"s{k}-{i}"} for i in range(2)]
        body = {"messageID": kind, "error": f"e{rnd.randrange(2)}", "message": f"m{k}", "guid": "g", "returnValue": str(k), "scriptStates": states}
        return (at, str(rnd.randrange(3)), "{broken" if rnd.random() < 0.1 else json.dumps(body))

    def put(rows):
        spark.createDataFrame(rows, "s int, target string, value string").select(F.timestamp_seconds("s").alias("ts"), "target", "value").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        raw = spark.readStream.schema("ts timestamp, target string, value string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        out = messages.console_stream(raw, 10)
        written = out.writeStream.outputMode("update").foreachBatch(lambda df, i: df.write.mode("overwrite").parquet(f"{tmp_path}/out/{i}"))
        written.option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination()

    times = [1000 + i for i in range(120)]
    late = [t - rnd.randrange(60) for t in times]  # within the hour's watermark
    sent = [message(k, t) for k, t in enumerate(late)]
    put(sent[:60])
    run()
    put(sent[60:])
    put([(20_000, "0", json.dumps({"messageID": 2, "message": "the end"}))])
    run()
    put([(40_000, "0", json.dumps({"messageID": 2, "message": "past the end"}))])
    run()
    whole = spark.read.parquet(f"{tmp_path}/in")
    row = lambda r: (r.kind, r.key, r.ts, r.text)
    want = sorted(map(row, messages.console_table(whole, 10).collect()), key=str)
    got = list(map(row, spark.read.parquet(*[str(p) for p in (tmp_path / "out").iterdir()]).collect()))
    scripts = {}
    for kind, key, ts, text in got:
        if kind == "script":
            scripts[key] = max(scripts.get(key, (ts, text)), (ts, text))
    now = sorted([("script", k, *x) for k, x in scripts.items()] + [x for x in got if x[0] != "script"], key=str)
    assert now == want and any(x[0] == "error" for x in want) and scripts


def test_spans_are_a_set_of_integers():
    rnd = random.Random(2)
    spans, kept = dedupe.Spans(), set()
    for _ in range(500):
        k = rnd.randrange(200)
        free = next(x for x in range(k, 400) if x not in kept)
        assert spans.first_free(k) == free
        if rnd.random() < 0.3:
            spans.add(free)
            kept.add(free)
            assert spans.top == max(kept)
    assert sum(e - b for b, e in zip(spans.begins, spans.ends, strict=True)) == len(kept) and all(e < b for e, b in zip(spans.ends, spans.begins[1:], strict=False))


def test_ids_tell_null_urls_from_others(spark):
    cards = [(1, "10", "x", None, 1001), (2, "10", None, "x", 1002), (3, "10", "x", "", 1003), (4, "10", "x", None, 1004), (5, None, "x", "x", 1)]
    df = spark.createDataFrame(cards, "ord int, deck_key string, face_url string, back_url string, card_id int")
    assert {r.ord: (r.new_key, r.new_card_id) for r in dedupe.global_deck_ids(df).collect()} == {1: (10, 1001), 2: (11, 1102), 3: (12, 1203), 4: (10, 1004)}
    own = df.select(F.lit("c").alias("container_id"), F.col("ord").alias("pos"), "deck_key", "face_url", "back_url", "card_id")
    assert {r.pos: r.new_key for r in dedupe.canonical_deck_ids(own).collect()} == {1: 10, 2: 11, 3: 12, 4: 10}


def test_canonical_ids_equal_the_sequential_rule(spark):
    rnd = random.Random(5)
    cards = [(rnd.choice("ab"), i, str(rnd.randrange(1, 12)), f"f{rnd.randrange(25)}", "b", i) for i in range(160)]
    want, state = {}, {}
    for c, pos, k, f, b, _ in cards:
        prints, taken = state.setdefault(c, ({}, set()))
        if (f, b) not in prints:
            prints[f, b] = int(k) if int(k) not in taken else max(taken) + 1
            taken.add(prints[f, b])
        want[c, pos] = prints[f, b]
    df = spark.createDataFrame(cards, "container_id string, pos int, deck_key string, face_url string, back_url string, card_id int").repartition(3)
    assert {(r.container_id, r.pos): r.new_key for r in dedupe.canonical_deck_ids(df).collect()} == want


def test_sorted_manifest_has_places_over_all_files(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", None, "c", "b", *(f"k{i:04}" for i in range(500))]], "name string").repartition(7)
    got = {r.id: r.position for r in sinks.sorted_manifest(df, "name").collect()}
    assert got == {x: i for i, x in enumerate(sorted(got))} and len(got) == 503
    assert sinks.sorted_manifest(df.limit(0), "name").count() == 0


def test_nested_sets_by_hand(spark):
    docs = [
        '{"ContainedObjects":[{"x":1}],"ObjectStates":[{"a":1,"ContainedObjects":[{"b":[{"c":1}]},3,{"d":2,"ContainedObjects":[]}]},{"e":1}]}', '{"ContainedObjects":[{"x":1},{"y":2}]}',
        '[{"a":1,"ContainedObjects":[{}]},[{"z":1}]]', "5", "{}", "broken", '{"ObjectStates":[],"ContainedObjects":[{}]}', None,
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "key int, text string")
    got = {}
    for r in nested.nested_sets(df, "key", "text", paths=True).orderBy("key", "enter").collect():
        got.setdefault(r.key, []).append((r.enter, r.leave, r.depth, r.parent, r.place, r.ord_path, r.object))
    assert got == {
        0: [(1, 3, 0, 0, 0, [0], '{"a":1,"ContainedObjects":[]}'), (2, 2, 1, 1, 0, [0, 0], '{"b":[{"c":1}]}'), (3, 3, 1, 1, 1, [0, 1], '{"d":2,"ContainedObjects":[]}'), (4, 4, 0, 0, 1, [1], '{"e":1}')],
        1: [(1, 1, 0, 0, 0, [0], '{"x":1}'), (2, 2, 0, 0, 1, [1], '{"y":2}')], 2: [(1, 2, 0, 0, 0, [0], '{"a":1,"ContainedObjects":[]}'), (2, 2, 1, 1, 0, [0, 0], "{}")], 4: [(1, 1, 0, 0, 0, [0], "{}")],
    }


def test_descendants_of_a_long_chain_and_a_cycle(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(90)] + [(3, 200), (None, 1)], "p int, c int")
    got = {(r.ancestor, r.descendant): r.depth for r in nested.descendants(edges, "p", "c").collect()}
    assert got == {(i, j): j - i for i in range(91) for j in range(i + 1, 91)} | {(i, 200): 4 - i for i in range(4)}
    with pytest.raises(ValueError):
        nested.descendants(spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "p int, c int"), "p", "c")


def test_members_of_a_document_are_set_and_dropped(spark):
    text = '{ "a" : 1, "b":{"a":2} ,"c":[1.50], "a":1}'
    new = trees.with_members(F.col("t"), {"a": F.col("x"), "b": F.lit(None).cast("string"), "c": F.lit("")})
    got = one(spark, new, t=text, x='{"q":1}')
    assert (got.content, got.changed) == ('{ "a" : {"q":1}, "b":{"a":2}, "a":{"q":1}}', True)
    got = one(spark, new, t='{"a":1.0}', x="1")
    assert (got.content, got.changed) == ('{"a":1.0}', False)
    assert one(spark, new, t="[1", x="1").content is None


def test_tables_of_the_application_are_removed(spark, tmp_path, monkeypatch):
    from docloom import checkpoints

    assert checkpoints.shared_dir(spark).endswith(f"docloom-{spark.sparkContext.applicationId}")
    monkeypatch.setattr(checkpoints, "shared_dir", lambda s: f"file://{tmp_path}/app")
    assert checkpoints.materialise(spark.range(5), "some").count() == 5
    assert len(list(tmp_path.glob("app/some-*"))) == 1
    checkpoints.release(spark)
    assert not list(tmp_path.iterdir())
