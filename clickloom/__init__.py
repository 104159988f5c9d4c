"""Clickstream analytics as Spark DataFrame jobs: profile, clean, aggregate, model, serve."""
