"""Sources and sinks: table scans, the canonical transactions adapter,
CSV edges and output writers."""
