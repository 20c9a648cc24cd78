"""Text-based user-item recommendation on Spark tables.

Every operator takes DataFrames and returns DataFrames; the work stays on the
executors.  See README.md for the layout.
"""
