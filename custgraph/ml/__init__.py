"""Feature tables, splits, training, model versions and scoring with Spark ML."""
