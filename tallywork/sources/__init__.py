"""Reading tables, declared schemas and writing results."""
