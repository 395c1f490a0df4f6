"""Reading and writing: files, tables, fitted state, audit records."""
