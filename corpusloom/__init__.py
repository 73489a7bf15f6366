"""corpusloom: retrieval-corpus building and training-data operators on Spark DataFrames."""
