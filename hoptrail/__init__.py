"""Reports over trace headers carried on event records, as Spark DataFrames."""
