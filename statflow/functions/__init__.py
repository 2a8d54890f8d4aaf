"""Column functions: scalars (F*), arrays (Y*) and fixed values."""
