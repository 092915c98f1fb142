"""Writers: day partitions, catalog tables, staged intermediate results."""
