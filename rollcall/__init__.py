"""rollcall: snapshot registries on Spark.

Layers: ``functions`` (Column expressions), ``sources`` (files, raw store,
publication), ``operators`` (corrections, canonicalisation, backfill, history,
marts, checks), ``plans`` (the registry chain, ingest plan, monthly close),
``streaming`` (incremental ingest). See README.md.
"""

__version__ = "0.1.0"
