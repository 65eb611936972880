"""Reading and writing: snapshots, delimited text, regions, target schemas."""
