"""DataFrame-to-DataFrame operators. Dates are parameters; nothing reads the wall clock."""
