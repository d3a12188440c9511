from vigil.sources.tables import read_table, TABLES
from vigil.sources.adapters import (
    CANONICAL_SCHEMA, require_columns, to_transactions,
    transactions_from_events, transactions_from_orders, derive_timestamp,
)

__all__ = [
    "read_table", "TABLES", "CANONICAL_SCHEMA", "require_columns", "to_transactions",
    "transactions_from_events", "transactions_from_orders", "derive_timestamp",
]
