"""Daily-snapshot data pipelines as Spark DataFrame operators."""
