"""Which stages of a job are done: a stage that is, isn't run again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "job string, stage string, result string, done_at timestamp"


class Ledger:
    """An append-only table of finished stages; of a stage that was noted twice the first note counts."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        there = p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)
        return self.spark.read.schema(SCHEMA).parquet(self.path) if there else self.spark.createDataFrame([], SCHEMA)

    def done(self, job: str, stage: str) -> bool:
        return not self.table().where((F.col("job") == job) & (F.col("stage") == stage)).isEmpty()

    def run(self, job: str, stage: str, action: Callable[[], object]) -> bool:
        """Runs the action and notes its end, unless the stage is done; whether it ran. An action that fails isn't noted."""
        if self.done(job, stage):
            return False
        result = action()
        self.spark.createDataFrame([(job, stage, str(result))], "job string, stage string, result string").withColumn("done_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path)
        return True
