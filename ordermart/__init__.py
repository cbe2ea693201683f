"""ordermart — batch order analytics expressed as Spark DataFrame / SQL / ML plans.

Layers:

* ``sources``   — feed readers, fixture feeds derived from driver tables, table
                  sinks (Parquet / JSON / CSV / TSV, snapshot overwrite, upsert, logs).
* ``functions`` — column-expression helpers (status mapping, buckets, money rounding, time).
* ``operators`` — DataFrame -> DataFrame operators (cleaning, quantiles, marts,
                  serving views, forecast).
* ``plans``     — composite jobs (clean, marts, SQL tasks) and the query catalog.
"""

__version__ = "0.1.0"
