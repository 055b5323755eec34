"""catalytics: data-catalog and event analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; Catalyst plans the
work. Sub-packages:

* ``sources``   -- catalog frames derived from the driver tables, event
  ingestion (batch and stream), preview, versioned snapshot publishing.
* ``functions`` -- Column-level helpers (key parsing, wildcards, text case).
* ``plans``     -- reusable plan fragments (top-k per key, size-checked
  broadcast, collect-distinct roll-ups, lineage-cutting checkpoints).
* ``operators`` -- catalog operators (details, usage, lineage, partitions,
  filters, search, change application, profiling, events).
* ``streaming`` -- Structured Streaming versions of the event and change
  products.
"""

__version__ = "0.1.0"
