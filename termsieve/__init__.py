"""termsieve: privacy-aware query-log analytics on Spark DataFrames."""
