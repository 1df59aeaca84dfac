"""cropmill: preference-data engine on Spark DataFrames."""
