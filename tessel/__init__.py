"""tessel: Spark-native analytics for producing and auditing training datasets."""
