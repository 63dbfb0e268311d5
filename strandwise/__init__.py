"""strandwise: evidence-graph analytics on PySpark DataFrames."""
