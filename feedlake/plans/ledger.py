"""A batch's journal: which steps of a load have begun and which are done, so that a run that stopped is taken up again.

Raw, history and audit are written one after the other and no single commit covers them. Before a step its entry says
`begun` with what the step must still know when it is repeated (such as the table's count before the load); after it
the entry says `done` with what the step found. A rerun of the same run id skips what is done, repeats what had only
begun (each step may be repeated) and goes on. Another run id of the batch starts anew.

The journal is a Parquet dataset with one small row a step, in a folder of its own that is replaced at commit.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.functions.columns import check_batch_date

LEDGER_SCHEMA = (
    "state string, details map<string,string>, event_time timestamp, stream string, batchdate string, run string, step string"
)
BEGUN, DONE = "begun", "done"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All entries: one row a step of a run; no rows before the first entry is written."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def committed_batches(spark: SparkSession, path: str, stream: str, last_step: str = "audit") -> DataFrame:
    """batchdate, run of the stream's loads whose last step is done: what readers may take as complete."""
    entries = read_ledger(spark, path)
    done = (F.col("stream") == stream) & (F.col("step") == last_step) & (F.col("state") == DONE)
    return entries.where(done).select("batchdate", "run")


class BatchLedger:
    """The journal of one run of one batch of a stream."""

    def __init__(self, spark: SparkSession, path: str, stream: str, batch_date: str, run_id: str = "1"):
        if not run_id or not stream:
            raise ValueError("a run needs a stream and a run id")
        self.spark, self.path, self.run_id = spark, path.rstrip("/"), run_id
        self.stream, self.batch_date = stream, check_batch_date(batch_date)

    def entries(self) -> dict[str, tuple[str, dict[str, str]]]:
        """step -> (state, details): a handful of rows, from this run's folders alone."""
        mine = (F.col("stream") == self.stream) & (F.col("batchdate") == self.batch_date) & (F.col("run") == self.run_id)
        rows = read_ledger(self.spark, self.path).where(mine).select("step", "state", "details").collect()
        return {r["step"]: (r["state"], dict(r["details"] or {})) for r in rows}

    def _write(self, step: str, state: str, details: Mapping[str, object]) -> None:
        text = {k: None if v is None else str(v) for k, v in details.items()}
        row = self.spark.createDataFrame([(state, text)], "state string, details map<string,string>").withColumns({
            "event_time": F.current_timestamp(), "stream": F.lit(self.stream), "batchdate": F.lit(self.batch_date),
            "run": F.lit(self.run_id), "step": F.lit(step),
        })
        (row.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("stream", "batchdate", "run", "step").parquet(self.path))

    def step(self, name: str, work: Callable[[], Mapping[str, object]], before: Callable[[], Mapping[str, object]] | None = None) -> dict[str, str]:
        """Run a step unless it is done; returns its details (strings). `before` is asked once, when the step first begins."""
        state, details = self.entries().get(name, (None, {}))
        if state == DONE:
            return details
        if state is None:
            details = dict(before()) if before else {}
            self._write(name, BEGUN, details)
        details = {**details, **work()}
        self._write(name, DONE, details)
        return {k: None if v is None else str(v) for k, v in details.items()}
