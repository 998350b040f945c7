"""Composite jobs: the three source transforms (D1-D3), the date dimension
(D4), dimension and fact loads (D5, D6) and star-schema analysis (N1-N4)."""
