"""martkeeper: governed analytics marts as Spark DataFrame operators.

Raw entity, event and monthly-revenue tables go through bronze, silver and gold layers; metric
views answer questions at any grouping; masks, row filters and key tokens are applied at the read
surface; grants are evaluated from a policy table. Everything is a lazy DataFrame composition.
"""

__version__ = "0.1.0"
