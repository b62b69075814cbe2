"""Column functions: text views of records and pair similarities."""
