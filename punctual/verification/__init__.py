"""Every operator and report as a named query over the driver's tables, with the SQL
that must give the same rows."""
