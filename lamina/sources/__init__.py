"""Sources and sinks: the fact store, tolerant scans, adapters from the driver tables."""
