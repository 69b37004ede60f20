"""Ball-by-ball match analytics as Spark DataFrame jobs.

``functions`` holds column expressions, ``operators`` holds functions from
DataFrame to DataFrame, ``sources`` reads and writes tables, and ``plans``
applies them to the driver's tables.
"""
