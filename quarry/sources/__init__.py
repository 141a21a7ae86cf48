from quarry.sources.tables import TABLES, read_csv, read_table, register_views

__all__ = ["TABLES", "read_table", "read_csv", "register_views"]
