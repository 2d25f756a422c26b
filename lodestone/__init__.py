"""A retrieval and knowledge-graph analytics engine on Spark DataFrames."""
