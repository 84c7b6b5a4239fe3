"""Layer compositions built from the operators."""
