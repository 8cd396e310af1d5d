"""DataFrame-to-DataFrame operators; none of them starts a job unless its docstring says so."""
