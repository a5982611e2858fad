"""Column-level helpers: renames, stamps, timestamp parsing, null-safe predicates."""
