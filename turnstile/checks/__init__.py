"""Every operator run on the test tables, next to the same question in plain SQL.

``QUERIES`` holds the Spark side and ``ORACLES`` the SQL side, by name.  The SQL
is written on its own: where Spark uses grouping sets the SQL has one branch
per total, where Spark cuts time into buckets the SQL compares the times, and
where Spark parses a text the SQL takes the value the text was made of.
"""

from turnstile.checks import ingest, joining, landing, mart, rows, totals
from turnstile.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "ingest", "joining", "landing", "mart", "rows", "totals"]
