"""Detail layer of a real-time e-commerce warehouse, written as Spark jobs.

Every operator takes and returns DataFrames and is built from Spark's own
expressions, so one definition serves batch and Structured Streaming.
"""
