"""tidemark: feature tables, online snapshots and scoring pipelines on PySpark."""
