"""marquee: a Spark-native pipeline and query library for title/people catalogues.

Layers (each a plain function returning a lazy DataFrame):

* ``sources``   -- bronze scans and sinks (TSV, Parquet, CSV, partitioned tables)
* ``plans``     -- staging models, the nested ``movies`` fact, person dimensions,
                   analytical questions, data tests and usage statistics
* ``operators`` -- reusable building blocks (ordered nesting, group top-k,
                   unnesting, per-person statistics)
* ``functions`` -- column-level helpers (safe casts, bands, exact rounding)
* ``streaming`` -- incremental append of usage records with Structured Streaming
"""

__version__ = "0.1.0"
