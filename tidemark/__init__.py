"""Order analytics on Spark: tolerant loading, change history, star schema, marts, reports, checks."""
