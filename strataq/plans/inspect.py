"""Plan text, for tests that hold a plan's shape."""

from pyspark.sql import DataFrame


def plan_text(df: DataFrame) -> str:
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
