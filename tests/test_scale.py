"""What keeps the work of a query in step with its input: dealt rows, bounded passes."""

import sys

import pytest

from docloom import checkpoints
from docloom.checkpoints import materialise
from docloom.functions.nesting import nested_objects
from docloom.functions.spans import Scanner, rewritten
from docloom.functions.trees import DropKeys, Emptied, RoundState
from docloom.operators import dedupe
from docloom.partitions import tasks_for
from docloom.plans import fixtures, jobs
from docloom.plans.fixtures import view
from docloom.plans.queries import registered

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registered()


class Counted(DropKeys):
    entered = 0

    def enter(self, frame):
        self.entered += 1
        super().enter(frame)


def test_lists_right_inside_lists_are_entered_once():
    text = '{"deep":' + "[" * 1000 + '{"k":1,"n":2}' + "]" * 1000 + ',"k":' + "[" * 1000 + "]" * 1000 + "}"
    rule = Counted(frozenset({"k"}))
    assert rewritten(text, Scanner(rule)) == ('{"deep":' + "[" * 1000 + '{"n":2}' + "]" * 1000 + "}", True)
    assert rule.entered < 10


@pytest.mark.parametrize(
    "text, want",
    [
        ("[[[1.5, [2.00]], [[3.0]]], 4.123456]", "[[[1.5, [2]], [[3]]], 4.1235]"),
        ("[ [ [ ] ] , [[]] ]", "[ [ [ ] ] , [[]] ]"),
        ('{"rot":[[[{"x":8}, 1.00]], 2.0]}', '{"rot":[[[{"x":15}, 1]], 2]}'),
        ("[[[1]]", None), ("[[1]]]", None), ("[[1],]", None), ("[[,1]]", None), ("[[1}]", None),
    ],
)
def test_lists_in_lists_close_one_by_one(text, want):
    assert rewritten(text, Scanner(RoundState()))[0] == want


def test_metadata_below_lists_is_emptied():
    text = '{"a":[1,[[{"GMNotes":"x"}],[[{"GMNotes":[[2]]}, 3]]]]}'
    assert rewritten(text, Scanner(Emptied(frozenset({"GMNotes"}))))[0] == '{"a":[1,[[{"GMNotes":""}],[[{"GMNotes":""}, 3]]]]}'


@pytest.mark.parametrize("name", ["src5_deep_documents", "doc16_clear_all_metadata", "doc1_untouched_text", "doc5_untouched_text", "doc6_untouched_text", "job_minimize_documents"])
def test_documents_of_a_small_file_are_dealt_to_several_tasks(spark, name):
    assert sum("/dealt-" in f for f in QUERIES[name](spark, SF).inputFiles()) > 1


def test_texts_are_rewritten_once_a_row(spark):
    """A filter on the result doesn't run the rule a second time."""
    plan = QUERIES["job_minimize_documents"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1


def test_an_object_is_read_in_a_few_calls():
    text, calls = '{"k":[],"ContainedObjects":[' * 1000 + "{}" + "]}" * 1000, 0
    assert len(list(nested_objects("{}", "ObjectStates", "ContainedObjects"))) == 1  # patterns are compiled once

    def count(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(count)
    try:
        found = list(nested_objects(text, "ObjectStates", "ContainedObjects"))
    finally:
        sys.setprofile(None)
    assert found[-1] == (1000, 1000, 999, 999, 0, "{}") and calls < 4 * len(found)


@pytest.mark.parametrize(
    "text, want",
    [
        ('{"Contained\\u004fbjects":[1,{"a":{"b":[{}]}},[{}], {"x":[ ]}]}', [(1, 1, 0, 0, 0, '{"a":{"b":[{}]}}'), (2, 2, 0, 0, 1, '{"x":[ ]}')]),
        (' [{"ContainedObjects" : [ ] ,"ContainedObjects":[{}]}, 2, {}]', [(1, 2, 0, 0, 0, '{"ContainedObjects" : [] ,"ContainedObjects":[]}'), (2, 2, 1, 1, 0, "{}"), (3, 3, 0, 0, 1, "{}")]),
        ('{"ContainedObjects":[{}],"ObjectStates":[{"ObjectStates":[{}]}]}', [(1, 1, 0, 0, 0, '{"ObjectStates":[{}]}')]),
        ('{"ContainedObjects":{}}', [(1, 1, 0, 0, 0, '{"ContainedObjects":{}}')]),
        ('{"ContainedObjects":[{},]}', []), ('{"a":1,}', []), ('{"ContainedObjects":[{}}', []), ('{"a":{"b":[1,]}}', []), ('[{}]]', []), ("{} {}", []), ("1", []), ("", []),
    ],
)
def test_objects_of_a_text(text, want):
    assert list(nested_objects(text, "ObjectStates", "ContainedObjects")) == want


def test_tasks_grow_with_the_rows(spark):
    assert tasks_for(spark.range(10)) == 4 and tasks_for(spark.range(2_500_001)) == 6
    dealt = dedupe.sort_deck(spark.createDataFrame([(1, 1, 7), (1, 2, 9)], "container_id int, pos int, card_id int"), "card_id", tasks=9)
    assert "RepartitionByExpression [container_id" in dealt._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.pos, r.new_pos) for r in dealt.orderBy("pos").collect()] == [(1, 2), (2, 1)]


def test_members_of_a_large_table_are_numbered_in_dealt_tasks(spark, monkeypatch):
    want = sorted(view(spark, SF, "members").collect())
    monkeypatch.setattr(fixtures, "tasks_for", lambda t: 9)
    dealt = view(spark, SF, "members")
    assert sorted(dealt.collect()) == want and dealt._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1


@pytest.mark.parametrize("name, members, cards", [("srt1_sort_deck", 2, 1), ("job_clean_decks", 1, 1), ("job_clean_decks_lists", 3, 0)])
def test_tables_are_read_and_joined_once(spark, name, members, cards):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert (plan.count("Relation [l_"), plan.count("Relation [p_")) == (members, cards)


def test_texts_are_parsed_once_a_row(spark, monkeypatch):
    """No filter on what is parsed stands ahead of the table of parsed texts."""
    plans = {}

    def kept(df, name="table"):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return materialise(df, name)

    monkeypatch.setattr(jobs, "materialise", kept)
    QUERIES["job_strip_localized_files"](spark, SF)
    assert "from_json" in plans["documents"] and "Filter" not in plans["documents"]


def test_written_texts_take_four_fifths_of_the_default_at_most(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(checkpoints, "shared_dir", lambda s: f"file://{tmp_path}/app")
    docs = spark.read.parquet(f"{SF}/documents.parquet").coalesce(1)
    docs.write.parquet(f"file://{tmp_path}/plain")
    kept = materialise(docs, "texts")
    size = lambda at: sum(p.stat().st_size for p in at.rglob("*.parquet") if p.is_file())
    assert 0 < size(tmp_path / "app") < 0.8 * size(tmp_path / "plain")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, docs.collect()))
