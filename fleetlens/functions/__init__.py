"""Column -> Column helpers built from Spark built-in functions only."""
