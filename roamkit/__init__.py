"""roamkit: telecom roaming report builds expressed as Spark DataFrame jobs.

Layout
------
functions/  column-level helpers (scalar expressions, all JVM built-ins)
operators/  DataFrame -> DataFrame building blocks (filters, joins, aggregates,
            windows, set operations, the roaming business operators)
sources/    table reads, versioned writes, ledgers, the test-table binding
plans/      end-to-end report builds, staged-load checks, the query catalog
"""

__all__ = ["config", "session"]
