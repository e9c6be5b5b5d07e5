"""Spark-native analytics for product event streams.

Every operator is a plain ``DataFrame -> DataFrame`` function; see the README
for the map from task to module.
"""
