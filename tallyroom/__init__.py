"""Reusable Spark analyses: monthly usage and tariff cost, listing reports,
purchase reports, table profiling and cleaning of messy sales files.

Everything takes and returns DataFrames and uses native expressions only.
"""
