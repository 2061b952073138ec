"""Column-level helpers: name resolution, typed literals, partition transforms."""
