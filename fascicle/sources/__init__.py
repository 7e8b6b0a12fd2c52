"""Reading and writing tables, folders and JSON payloads."""
