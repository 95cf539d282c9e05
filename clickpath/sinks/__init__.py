from clickpath.sinks.warehouse import Load, Snapshot, Warehouse

__all__ = ["Load", "Snapshot", "Warehouse"]
