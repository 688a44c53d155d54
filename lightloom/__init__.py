"""Analytics for large stores of irregularly sampled brightness series, written as PySpark plans."""
