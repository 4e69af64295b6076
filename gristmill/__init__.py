"""From raw files to decision tables on Spark DataFrames."""
