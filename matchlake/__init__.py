"""matchlake: ball-by-ball match analytics as plain Spark DataFrame jobs.

Sub-packages:

* ``sources``   – document scans, id listing, parquet/CSV reads, sinks.
* ``functions`` – column expressions (no DataFrame in, Column out).
* ``operators`` – DataFrame -> DataFrame transforms (extraction, people,
  facts, star schema, reports, incremental ingest, skew helpers).
* ``plans``     – driver-table stand-ins and the registered query catalogue.
* ``streaming`` – file-source stream form of the incremental ingest.
"""

from matchlake.session import get_session, scratch_dir  # noqa: F401

__version__ = "0.1.0"
