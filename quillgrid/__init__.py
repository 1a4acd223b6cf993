"""A Spark-native engine for layout analytics and training-data preparation."""
