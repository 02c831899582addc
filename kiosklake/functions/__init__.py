"""Column-returning functions: everything here stays inside Catalyst expressions."""
