"""Data checks that return rows: check, table_name, column_name, failed, total."""
