"""Star-schema warehouse for delivery orders, built on Spark DataFrames."""
