"""How rows are dealt to tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from docloom.checkpoints import materialise


#: Rows of a table to a task that sorts them.
TASK_ROWS = 500_000


def tasks_for(table: DataFrame, rows: int = TASK_ROWS) -> int:
    """How many tasks to deal a saved table's rows to, so that what one sorts doesn't grow with the table: as its files count
    their rows, and the session's shuffle partitions at least."""
    return max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-table.count() // rows))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by key to several tasks a core, ahead of work that costs far more than reading them does: a small file is
    one task, whatever its rows grow into. Shuffles the rows as they are, so it goes before what makes them large; they are
    written, as filters on what is made of them would else be worked out ahead of the shuffle, in that one task."""
    spark = df.sparkSession
    return materialise(df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys), "dealt")
