"""Reading facts, tables, relational sources and station reports."""
