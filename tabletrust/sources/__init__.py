from tabletrust.sources.tables import DRIVER_TABLES, read_table, read_with_contract

__all__ = ["DRIVER_TABLES", "read_table", "read_with_contract"]
