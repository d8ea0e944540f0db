"""Column expressions: cleansing, privacy and feature formulas."""
