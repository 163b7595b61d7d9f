"""Type rules and the column expressions built on them."""
