"""Column expressions: parsing, cleaning and arithmetic.  No UDFs."""
