"""Operational analytics and applied statistics over Spark DataFrames.

Sub-packages
------------
sources    reading tables, SQL texts, CSV files, calendars
functions  column expressions (dates, ratios, geography, text)
operators  DataFrame -> DataFrame statistics
plans      multi-step business reports
catalog    the registered queries over the star-schema tables
"""
