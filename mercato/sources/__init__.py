"""Sources and sinks: layer IO and the test-data mapping views."""
