"""Sources and sinks: message logs, columnar batch files, snapshot tables."""
