"""Churn analytics for subscription-service API logs, on Spark DataFrames."""
