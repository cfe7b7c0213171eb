"""textloom: a Spark-native engine for building and querying text-training corpora."""
