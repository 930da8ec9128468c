"""Sources and sinks: table loading, domain fixture views, readers, writers."""
