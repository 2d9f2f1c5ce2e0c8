"""tarmac: flight-operations lakehouse transforms written as Spark DataFrame jobs."""
