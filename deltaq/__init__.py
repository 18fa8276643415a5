"""deltaq: keep a join-and-aggregate result right under INSERT/DELETE changelogs, on Spark.

Subpackages: ``sources`` (scans and sinks), ``functions`` (column expressions), ``operators``
(parse/route/quarantine, replay, synthesis, reconciliation), ``streaming`` (normaliser and the
streaming queries), ``plans`` (the flagship query, the registered queries and their oracles).
"""
