"""Model training, scoring and parameter search on Spark ML."""
