"""Spark-native extraction of news articles and feeds from tables of web pages."""
