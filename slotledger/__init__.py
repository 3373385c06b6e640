"""Warehouse slot-occupancy ledger on PySpark.

Landed JSON documents become typed tables, one signed movement ledger, running
and daily balances, billable pallet-place-days, marts and quality reports.
Every transformation is a lazy ``DataFrame -> DataFrame`` function.
"""

from slotledger.session import build_session

__all__ = ["build_session"]
