"""Reading and writing: monthly trip files, load audit, zones, tables, run ledger."""
