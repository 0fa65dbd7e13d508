"""ndflow: NDJSON record-file pipelines (scan, bundle split and reassembly,
de-identification, quality checks, run ledger, progress analytics) as Spark
DataFrame operations."""

__version__ = "0.1.0"
