"""Jobs and reports composed from the operators."""
