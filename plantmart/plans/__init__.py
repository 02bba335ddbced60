"""Jobs that write: ingestion, replica vault, warehouse reload, star reads and the daily run."""
