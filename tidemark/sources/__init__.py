"""Reading landed files, reading and writing tables."""
