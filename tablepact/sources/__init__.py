"""Reading sources and contracts, writing layers and snapshots."""
