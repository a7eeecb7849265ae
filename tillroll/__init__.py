"""Retail order analytics as plain Spark jobs.

Every public function takes DataFrames and returns DataFrames, so stages chain
with ``df.transform`` and Catalyst sees one plan from the scan to the result.
The caller supplies the ``SparkSession``; nothing here creates or stops one.
"""
