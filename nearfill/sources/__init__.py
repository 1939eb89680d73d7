from .io import load_splits, read_checked, read_table, with_row_key, write_table

__all__ = ["load_splits", "read_checked", "read_table", "with_row_key", "write_table"]
