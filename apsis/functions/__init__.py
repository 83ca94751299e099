"""Column expressions; none of them is a Python function at run time, but for the propagator."""
