"""Writers of tables and raw files."""
