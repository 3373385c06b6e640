"""The ledger's meaning in plain Python, row by row, for small inputs."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

DAY = dt.timedelta(days=1)


def parts(op):
    q = op["quantity"] or 0
    moved = op["doc_type"] == "move"
    return {
        "real_in": 0 if moved else max(q, 0),
        "real_out": 0 if moved else min(q, 0),
        "move_in": max(q, 0) if moved else 0,
        "move_out": min(q, 0) if moved else 0,
    }


def balances(ops):
    """id -> (open slot, close slot, open total, close total)."""
    slot, total, out = defaultdict(int), defaultdict(int), {}
    for op in sorted(ops, key=lambda o: (o["moment"] is None, o["moment"] or 0, o["id"])):
        p = parts(op)
        place = (op["store_id"], op["slot_id"], op["item_id"])
        before = slot[place], total[op["item_id"]]
        slot[place] += op["quantity"] or 0
        total[op["item_id"]] += p["real_in"] + p["real_out"]
        out[op["id"]] = (before[0], slot[place], before[1], total[op["item_id"]])
    return out


def dense(ops, as_of):
    """Every grain and day with its balances, the long way round."""
    moved = defaultdict(lambda: defaultdict(int))
    first = {}
    for op in ops:
        if op["moment"] is None:
            continue
        place, day = (op["store_id"], op["slot_id"], op["item_id"]), op["moment"].date()
        first[place] = min(first.get(place, day), day)
        if op["store_id"] is None:  # such a grain never meets its own movements
            continue
        cell = moved[(*place, day)]
        cell["quantity"] += op["quantity"] or 0
        for name, value in parts(op).items():
            cell[name] += value
    grid, opening = [], {}
    for place, day in first.items():
        stock = 0
        while day <= as_of:
            cell = moved.get((*place, day), {})
            row = {
                "store_id": place[0], "slot_id": place[1], "item_id": place[2], "moment_day": day,
                "open_slot_balance": stock,
                **{n: cell.get(n, 0)
                   for n in ("quantity", "real_in", "move_in", "real_out", "move_out")},
            }
            stock += row["quantity"]
            row["close_slot_balance"] = stock
            grid.append(row)
            day += DAY
    by_item = defaultdict(lambda: defaultdict(int))
    for row in grid:
        by_item[row["item_id"]][row["moment_day"]] += row["real_in"] + row["real_out"]
    for item, days in by_item.items():
        running = 0
        for day in sorted(days):
            opening[item, day] = running
            running += days[day]
    for row in grid:
        before = opening[row["item_id"], row["moment_day"]]
        row["open_total_balance"] = before
        row["close_total_balance"] = before + by_item[row["item_id"]][row["moment_day"]]
        close = row["close_slot_balance"]
        row["is_used"] = 1 if close > 0 else 2 if close < 0 else int(row["real_out"] != 0)
    held = defaultdict(int)
    for row in grid:
        if row["close_slot_balance"] > 0 and row["slot_id"] != "off_slot":
            held[row["store_id"], row["slot_id"], row["moment_day"]] += 1
    for row in grid:
        row["items_in_slot"] = held[row["store_id"], row["slot_id"], row["moment_day"]]
    return grid


def used(grid, owner):
    """(depositor, day) -> number of distinct occupied slots."""
    seen = defaultdict(set)
    for row in grid:
        if row["is_used"] == 1 and row["slot_id"] != "off_slot":
            seen[owner[row["item_id"]], row["moment_day"]].add(row["slot_id"])
    return {key: len(slots) for key, slots in seen.items()}


def rollup(grid):
    """(item, day) -> (open total, real quantity, close total) over used rows."""
    out = {}
    for row in grid:
        if row["is_used"]:
            key = row["item_id"], row["moment_day"]
            real = out.get(key, (0, 0, 0))[1] + row["real_in"] + row["real_out"]
            out[key] = row["open_total_balance"], real, row["close_total_balance"]
    return out
