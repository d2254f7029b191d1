"""Ledgerline: Spark operators for a financial warehouse and its analytics.

Every operator takes a DataFrame plus column names and returns a DataFrame.
"""
