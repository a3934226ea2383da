"""Column rules and DataFrame helpers shared by the operators."""
