"""sensorlake: sensor-reading analytics on Spark (DataFrames, Structured
Streaming, Spark ML). Operators live in ``operators``, ``sources``, ``sinks``,
``streaming`` and ``ml``; end-to-end plans and registered queries in ``plans``."""

__version__ = "0.1.0"
