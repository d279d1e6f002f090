"""Source-knowledge graphs and retrieval-QA evaluation data as Spark DataFrames."""
