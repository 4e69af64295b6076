"""Reading raw files, loading declared tables, and writing results."""
