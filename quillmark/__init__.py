"""Evidence-document analytics as Spark DataFrame, SQL and streaming pipelines."""
