"""Readers: text records, file inventories, marker files, delimited tables, configs."""
