"""Daily time-series analytics over many keyed series, written as Spark DataFrame jobs."""
