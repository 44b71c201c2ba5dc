"""Reading and writing listing tables, feeds, pages and samples."""
