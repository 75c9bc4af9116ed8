"""Column expressions: sequence text, loci, alignment strings, attributes."""
