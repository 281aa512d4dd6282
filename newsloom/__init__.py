"""newsloom: Spark-native operators for news-feed data products and training corpora."""
