"""The query catalog (``catalog``), its shared frames and SQL twins."""
