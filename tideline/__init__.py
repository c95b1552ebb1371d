"""Event analytics on Spark: DataFrame operators over landed service payloads."""
