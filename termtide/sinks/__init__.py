"""Writers for tables, messages and streams."""
