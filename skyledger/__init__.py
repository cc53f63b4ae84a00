"""Exact, mergeable weather-station statistics on Spark.

Readings arrive as messages or tables, are cleaned once, and are reduced to
(sum, count) states that merge exactly however the input was split. Data
products and models are built on those states.
"""
