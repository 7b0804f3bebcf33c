"""labormart: job-market ELT and analytics on Spark DataFrames.

Landed vacancy and exchange-rate JSON documents → typed detail tables →
metrics and skill marts → read queries and dashboard tables, in a full and an
incremental pipeline. Every operator is DataFrame → DataFrame and lazy.
"""

from labormart.semantics import CORRECTED, REFERENCE, Semantics

__all__ = ["Semantics", "REFERENCE", "CORRECTED"]
__version__ = "0.1.0"
