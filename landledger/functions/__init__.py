"""Column expressions: names, typed text, identifiers, geometry and small scalars."""
