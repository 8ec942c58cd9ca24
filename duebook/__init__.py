"""Receivables analytics as Spark DataFrame transformations.

Every public function takes and returns DataFrames (or Columns) and stays lazy;
the as-of date is always an argument.  Only the table writers in
``duebook.sources.tables`` and ``assert_healthy`` start jobs.
"""
