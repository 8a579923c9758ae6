"""Table replication and history on Spark.

Reads source tables whole, by filter or by changed rows only, stages them as
delimited files, loads them back typed, and applies them to versioned targets.
"""
