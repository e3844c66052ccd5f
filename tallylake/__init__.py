"""Change-data-capture lakehouse and ledger analytics as Spark jobs."""
