"""Sources and sinks: message streams, corpus files, snapshot tables."""
