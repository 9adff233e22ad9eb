"""Every operator bound to the given tables, with the SQL that checks it."""
