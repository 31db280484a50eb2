"""ledgerlake: spending analytics (ingest, checks, staging, snapshots, marts,
insights) as Spark DataFrame jobs."""

__version__ = "0.1.0"
