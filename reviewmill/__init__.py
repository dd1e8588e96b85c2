"""Review analytics on Spark DataFrames: clean, profile, sample, split, recommend, and forecast."""
