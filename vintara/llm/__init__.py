"""Operators of a training-data pipeline, their queries and their SQL.

Nothing outside this folder imports it; ``__spark_entry__`` adds the queries if it is there.
"""
