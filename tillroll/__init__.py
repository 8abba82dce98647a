"""tillroll — a Spark-native retail analytics pipeline.

Feeds -> cleaning and validation in one tagged pass (rejects kept with their
reasons) -> versioned bronze upserts -> quality gate -> star schema -> reports.
"""

__version__ = "0.1.0"
