"""docketflow: DataFrame, SQL and Structured Streaming operators for corpora of official publications."""
