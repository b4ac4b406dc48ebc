"""Domain jobs built on the operators."""
