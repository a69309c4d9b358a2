"""Reading landed files, flattening nested documents, writing tables."""
