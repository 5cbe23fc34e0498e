"""ecoflux — a Spark-first climate and energy lakehouse.

Layers:
  * ``ecoflux.functions``  Column -> Column expressions (decimal commas, UTC->local dates ...)
  * ``ecoflux.operators``  DataFrame -> DataFrame transforms, incremental helpers, data dictionary
  * ``ecoflux.sources``    readers, writers and the driver-table adapters
  * ``ecoflux.plans``      silver and gold result builders and the end-to-end pipeline
  * ``ecoflux.streaming``  file-triggered incremental landing (Structured Streaming, AvailableNow)

Everything is expressed with the DataFrame API so Catalyst can prune, push down and
re-plan; there is no Python UDF anywhere.
"""

from ecoflux.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
