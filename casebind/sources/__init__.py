"""Where frames come from: SQL, catalog tables, files, ledgers."""
