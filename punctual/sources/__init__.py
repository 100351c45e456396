"""Reading and writing: day files, the landing zone, tables, lake files, the manifest."""
