"""Job-market analytics as Spark DataFrame jobs.

Every operator takes DataFrames and returns DataFrames (or Columns); nothing is
collected to the driver except bounded facts such as a hot-key list or a page
total.  Time is always a parameter (``as_of``), never the wall clock.
"""
