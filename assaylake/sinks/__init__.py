"""Writers: raw partitions, mart tables, upserts, reports."""
