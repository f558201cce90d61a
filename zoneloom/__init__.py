"""zoneloom: classified polygon zones on Spark DataFrames."""
