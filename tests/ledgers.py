"""Small random ledgers and the directories that go with them."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

from slotledger.operators.ledger import ITEM_COLUMNS

AS_OF = dt.date(2024, 4, 10)
OPS = (
    "id BIGINT, doc_id STRING, applicable BOOLEAN, moment TIMESTAMP_NTZ, number STRING, "
    "agent_id STRING, store_id STRING, item_id STRING, quantity DECIMAL(18,6), slot_id STRING, "
    "updated TIMESTAMP_NTZ, doc_type STRING, op_type STRING"
)
ITEMS = (
    "item_id STRING, depositor_id STRING, expected_bin_qty DECIMAL(18,6), name STRING, "
    "updated TIMESTAMP_NTZ, product STRING, lot STRING, mfg_date STRING, article STRING, "
    "weight DECIMAL(18,6), volume DECIMAL(18,6), uom STRING, depositor_name STRING, "
    "depositor_inn STRING"
)


def random_ops(seeds: range, size: int = 25) -> list[dict]:
    """Ledgers of many seeds in one; each seed has items, slots and stores of its own."""
    ops = []
    for seed in seeds:
        rng = random.Random(seed)
        for _ in range(rng.randint(1, size)):
            day = dt.datetime(2024, 1, 20) + dt.timedelta(days=rng.randint(0, 90))
            kind = rng.choice(["supply", "enter", "demand", "loss", "move"])
            amount = rng.randint(0, 5)
            sign = {"supply": 1, "enter": 1, "demand": -1, "loss": -1}.get(kind, rng.choice([1, -1]))
            ops.append(
                {
                    "id": len(ops) + 1,
                    "doc_id": f"d{seed}-{rng.randint(0, 9)}",
                    "applicable": True,
                    "moment": None if rng.random() < 0.03
                    else day + dt.timedelta(hours=rng.choice([0, 0, 9])),
                    "number": str(len(ops)),
                    "agent_id": None if kind == "move" else "a1",
                    "store_id": None if rng.random() < 0.05 else f"st{seed}-{rng.randint(0, 1)}",
                    "item_id": f"i{seed}-{rng.randint(0, 2)}",
                    "quantity": None if rng.random() < 0.03 else Decimal(sign * amount) / 2,
                    "slot_id": "off_slot" if rng.random() < 0.2
                    else f"s{seed}-{rng.randint(0, 2)}",
                    "updated": day,
                    "doc_type": kind,
                    "op_type": "in" if sign > 0 else "out",
                }
            )
    return ops


def ops_frame(spark, ops):
    names = [c.split()[0] for c in OPS.split(", ")]
    return spark.createDataFrame([tuple(op[n] for n in names) for op in ops], OPS)


def owners(ops) -> dict[str, str]:
    return {op["item_id"]: f"dep{op['item_id'][-1] in '12'}" for op in ops}


def items_frame(spark, ops):
    rows = []
    for item, owner in sorted(owners(ops).items()):
        row = dict.fromkeys(ITEM_COLUMNS)
        row.update(
            item_id=item, depositor_id=owner, name=f"Item {item}", depositor_name=f"Name {owner}",
            expected_bin_qty=None if item.endswith("0") else Decimal(2),
        )
        rows.append(tuple(row[c] for c in ITEM_COLUMNS))
    return spark.createDataFrame(rows, ITEMS)


def op_frame_columns() -> list[str]:
    return [c.split()[0] for c in OPS.split(", ")]
