"""weirflow: lakehouse ingestion and dimensional reporting as plain Spark jobs.

Layers, lowest first:

* ``functions``  Column -> Column helpers (cleaning, derivation)
* ``operators``  DataFrame -> DataFrame (ranking, quarantine, star join, stamps)
* ``sources`` / ``sinks``  files, monthly drops, literal rows, JDBC
* ``streaming``  file streams, watermark dedup, routing, checkpointed sinks
* ``plans``      the complete jobs, thin compositions of the above
"""
