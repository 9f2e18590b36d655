"""Labelled-text analytics as Spark DataFrame jobs.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns); nothing is collected to the driver except results whose size is fixed
by a parameter (k x k matrices, one-row summaries).
"""
