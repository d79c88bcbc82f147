"""Column-expression helpers (pure ``Column -> Column``)."""
