"""Panel time-series analytics expressed as Spark DataFrame transformations."""
