"""Case-file analytics on Spark: ingest, reconcile, version, snapshot, report."""
