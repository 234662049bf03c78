"""docweave: document analytics on Spark DataFrames."""
