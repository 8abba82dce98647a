"""Sources and sinks: feed readers, fixture feeds, table store, audit sinks."""
