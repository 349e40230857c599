"""Training-data preparation and sequence analytics as Spark DataFrame operators."""
