"""Keep an analytical warehouse current with Spark DataFrames."""
