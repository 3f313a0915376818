"""Column-returning functions (no Python UDFs): scalar helpers and the
feature specification."""
