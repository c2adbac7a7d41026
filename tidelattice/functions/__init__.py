"""Column expressions: dates, strings, geometry, grid indices and attributes."""
