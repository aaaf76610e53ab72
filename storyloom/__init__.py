"""storyloom: a Spark-native engine that turns crawled customer stories into a queryable dataset."""
