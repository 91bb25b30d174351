"""Compositions of the operators: table binding, query catalogue, daily job."""
