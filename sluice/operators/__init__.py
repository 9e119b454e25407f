"""DataFrame -> DataFrame operators. No I/O here; clocks are arguments."""
