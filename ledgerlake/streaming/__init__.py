"""Work that follows what arrives."""
