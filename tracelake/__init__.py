"""Trial-aligned signal analytics and corpus preparation on Spark DataFrames."""
