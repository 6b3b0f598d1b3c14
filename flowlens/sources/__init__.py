from flowlens.sources.packets import (  # noqa: F401
    events_as_packets,
    read_packets_csv,
    read_packets_parquet,
    read_table,
    scan_nrows,
)
from flowlens.sources.hosts import host_dim  # noqa: F401
