"""adfeed: classified-ad feed processing as Spark DataFrame jobs."""
