"""Table readers, fixture views, loaders and sinks."""
