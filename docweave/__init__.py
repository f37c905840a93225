"""docweave: document-graph analytics on PySpark DataFrames."""
