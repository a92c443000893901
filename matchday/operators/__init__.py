"""Generic, parameterised DataFrame operators."""
