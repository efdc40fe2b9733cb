"""Reading landed files and writing layer tables."""
