"""DataFrame-to-DataFrame operators; key columns are parameters."""
