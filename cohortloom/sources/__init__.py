"""Reading and writing: delimited files, the layered lake, shared scratch space."""
