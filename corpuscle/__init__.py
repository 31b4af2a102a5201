"""corpuscle: knowledge-graph and document analytics on Spark DataFrames."""
