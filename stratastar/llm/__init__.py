"""Operators of a training-data pipeline; queries and checking SQL are in `stratastar.llm.queries`."""
