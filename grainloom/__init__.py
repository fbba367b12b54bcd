"""grainloom: a Spark-native engine for curating language-model training data."""
