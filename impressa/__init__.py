"""Engagement analytics on Spark DataFrames: features, models and scores from impression logs."""
