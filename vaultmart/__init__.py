"""vaultmart: a layered warehouse (staging -> ODS -> Data Vault -> marts) built on
Spark DataFrames.

Every builder takes DataFrames and returns a lazy DataFrame; only
``vaultmart.sources.tables`` does IO.  Catalyst plans the joins, aggregations
and pushdowns; AQE handles partition sizing and skewed keys at run time.
"""

__all__ = ["session"]
