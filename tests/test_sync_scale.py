"""Jobs and joins on tables whose packed files are far smaller than their rows."""

from docloom.plans.queries import registered

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registered()


def test_synced_records_are_never_gathered_for_a_broadcast(spark):
    plan = QUERIES["job_sync_records"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
