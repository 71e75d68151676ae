"""DataFrame -> DataFrame operators over vector tables ``(row_id, features, label)``."""
