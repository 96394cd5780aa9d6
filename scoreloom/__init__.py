"""Document features and ordinal scoring on Spark."""
