"""Record triage on Spark: ingest, score under a budget, check, sample and report."""
