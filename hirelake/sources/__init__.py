"""Table schemas, constraint rules, storage and import/export."""
