"""Column expressions: text, keys, labels, values, tax formulas, XML."""
