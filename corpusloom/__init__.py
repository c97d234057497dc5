"""corpusloom: build and query a document corpus with Spark DataFrames."""
