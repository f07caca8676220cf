"""Column expressions: casts, audit columns, trip derivations, demand features."""
