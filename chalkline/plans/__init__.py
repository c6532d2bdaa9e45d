"""The K-12 tables built from the operators."""
