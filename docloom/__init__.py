"""docloom: DataFrame operators for corpora of nested JSON documents, on Spark."""
