"""Reports and table jobs, each one declarative plan over a set of tables."""
