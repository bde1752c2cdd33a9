"""lograft: key/value log ingest, normalisation and rollups on PySpark.

Every transform is a ``DataFrame -> DataFrame`` function built from native
column expressions, so the same code runs in batch and in Structured
Streaming and stays inside Catalyst / whole-stage codegen.
"""

__version__ = "0.1.0"
