"""Writers of tables, results and messages."""
