"""Declarative jobs: specs, warehouse tables, loads, exports, ledger, runner."""
