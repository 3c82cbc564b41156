"""DataFrame operators. Every function takes and returns DataFrames and keeps its work on the executors."""
