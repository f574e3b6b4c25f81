"""Sources and sinks: table reads, replay-safe sync, compaction."""

from meterlake.sources.tables import Tables, load

__all__ = ["Tables", "load"]
