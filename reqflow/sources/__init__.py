"""Reading and publishing tables and files."""
