"""Row operators: source-to-target mapping, nested flattening, change-detecting
merge, high watermarks."""
