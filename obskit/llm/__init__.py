"""Training-data operators: ten components that nothing else in the library imports."""
