"""Point-of-sale analytics as Spark DataFrame operators."""
