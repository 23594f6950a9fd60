"""tidewater: change-log analytics on Spark.

Landed change files -> append-only change logs -> keyed current state (SCD1/SCD2)
-> star-schema gold datasets, in batch or incrementally, on public Spark APIs.
"""

__version__ = "0.1.0"
