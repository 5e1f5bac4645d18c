"""Retail data quality and reporting as lazy Spark plans.

``sources`` reads and writes tables, ``operators`` holds the reusable checks and
repairs, ``functions`` the column expressions they share, and ``plans`` puts
them together into the raw, store and publish layers and the two reports.
"""
