"""Column-expression builders (pure ``Column`` -> ``Column``)."""
