"""Reading and writing: keyed topics, tables, exports, raw landing."""
