"""Sales warehouse on Spark: sources, staging, star schema, finance mart, data checks."""
