"""Ready-made queries and the evaluation cycle built from the operators."""
