"""Retail warehouse analytics as plain PySpark jobs.

Every job is a function from DataFrames (plus a run date) to a DataFrame.
"""
