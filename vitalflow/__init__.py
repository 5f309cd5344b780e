"""vitalflow: a PySpark-native activity-analytics pipeline.

CDC activity events -> deduplicated, rule-checked bronze / quarantine tables;
an HR referential with commute-distance checks; per-employee eligibility and
per-unit KPI tables; what-if sweeps; data-quality checks; notification and
alert messages. Every stage is a DataFrame -> DataFrame function that runs on
batch tables and, where marked, on Structured Streaming DataFrames.
"""

__version__ = "0.1.0"
