"""Reading from and writing to tables, files and landed connector streams."""
