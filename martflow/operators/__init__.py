"""Row-level and table-level operators, one module per family."""
