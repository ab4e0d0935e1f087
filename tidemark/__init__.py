"""tidemark — marketing-analytics warehouse on Spark.

Layers:

* ``sources``    readers: driver tables → warehouse facts, landed API reports, CSV exports
* ``functions``  column helpers (week numbers, safe casts, percent change, formatting)
* ``operators``  reusable DataFrame operators (window replace, upsert, prefix share,
                 nested distinct counts, calendar, period comparison)
* ``plans``      marts, served queries and quality checks as DataFrame → DataFrame functions
* ``streaming``  landed-file refresh driven by Structured Streaming (``foreachBatch``)
"""

from tidemark.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
