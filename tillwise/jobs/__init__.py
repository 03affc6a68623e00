"""Jobs to submit: batch load, stream ingestion, merge with recompute."""
