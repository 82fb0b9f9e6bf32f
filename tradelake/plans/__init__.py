"""Batch plans: lake writer, tables and ledger, incremental loader."""

from .compact import compact_days
from .ledger import already_loaded, compact_ledger, is_loaded, ledger_view
from .loader import load_batch, recover
from .tables import TableNames, ensure_tables, fact_view, ledger_id, resolve_names, rows_to_add, trades_between
from .writer import read_outcomes, write_outcomes, write_trades

__all__ = [
    "compact_days", "compact_ledger", "rows_to_add", "load_batch", "recover", "TableNames", "already_loaded", "ensure_tables", "fact_view",
    "is_loaded", "ledger_id", "ledger_view", "resolve_names", "trades_between", "read_outcomes", "write_outcomes", "write_trades",
]
