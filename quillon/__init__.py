"""Quillon: tabular, text, embedding and ML analytics written as Spark jobs.

Sub-packages: ``sources`` (readers and sinks), ``functions`` (Column helpers), ``operators`` (DataFrame in, DataFrame
out), ``plans`` (the registered queries and their SQL), ``streaming`` (what holds on unbounded inputs).
"""

__version__ = "0.1.0"
