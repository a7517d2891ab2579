"""marketlake: a Spark-native medallion engine for landed prediction-market events."""
