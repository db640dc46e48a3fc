"""Joins, histories, tasks and quality tables as functions from DataFrames to DataFrames."""
