"""A Spark-native engine for curating corpora into partitioned training shards."""
