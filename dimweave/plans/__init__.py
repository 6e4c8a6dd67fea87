"""Jobs built from the operators: dimension steps, the full load, sample data, registered queries."""
