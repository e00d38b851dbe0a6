"""Profile, prune, diff and check large multi-part Parquet releases with Spark."""
