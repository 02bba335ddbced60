"""Config-driven ingestion, typed warehouse reload, contract checks and star reads on Spark."""
