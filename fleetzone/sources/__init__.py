"""Sources and sinks: zone layers, CSV extracts, reports, JDBC, test tables."""
