"""Column-expression functions: calendar (F1-F5, F10, G1) and text."""
