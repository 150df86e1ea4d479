"""samewise: record linkage on Spark DataFrames."""
