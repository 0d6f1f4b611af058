"""Sources and sinks: explicit schemas (``schemas``), readers (``tables``),
report sources derived from the driver's tables (``mapped``) and the
partitioned report writer (``sinks``)."""
