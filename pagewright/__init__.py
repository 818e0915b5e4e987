"""pagewright: document-text analytics on Spark DataFrames."""
