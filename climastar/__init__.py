"""climastar: city climate star schema on Spark.

Reads airport codes, city demographics and monthly surface temperatures,
cleans them with native Spark expressions, joins them by city into one
fact table and two dimension tables, checks the written tables and answers
per-city reports.  Everything is expressed as DataFrame plans so that
Catalyst prunes columns, pushes filters into the scans and picks the join
strategy; see README.md for the plan-level design notes.
"""

__version__ = "0.1.0"
