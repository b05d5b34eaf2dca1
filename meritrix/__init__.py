"""Labour-market analytics on PySpark: postings, employment and wage tables."""
