"""Writers: sorted tables, segment shards, ordered publishing."""
