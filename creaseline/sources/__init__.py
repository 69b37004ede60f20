"""Reading and writing documents and tables."""
