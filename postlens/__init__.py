"""Sentiment and trend analytics over large post collections, as Spark DataFrame jobs."""
