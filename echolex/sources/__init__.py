"""Reading, mapping and writing of posts and tables."""
