"""Risk scoring of short text messages as Spark DataFrame operators."""
