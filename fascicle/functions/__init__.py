"""Column functions: everything here maps Columns to one Column."""
