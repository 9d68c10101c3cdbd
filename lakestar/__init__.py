"""lakestar: batch lakehouse refinement on PySpark.

Raw JSON envelopes -> flatten -> quality gate -> latest version per key ->
clean and type -> surrogate keys -> upsert into versioned tables -> star
schema -> one wide report -> season questions.  Every step is a DataFrame
operator; Catalyst and AQE choose the physical plan.
"""

__version__ = "0.1.0"
