"""monsoon: demand analytics for sparse monthly series, written for Spark's DataFrame API."""
