"""Sources and sinks: driver-table fixtures, CSV landing/loading, tables."""
