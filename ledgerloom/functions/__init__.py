"""Column-level helpers: fixed labels, money casts, calendar arithmetic,
and the scalable running-sum building block."""
