"""One daily run over landed files.

    python -m slotledger --landing FOLDER --root FOLDER [--as-of DAY]

``FOLDER`` of ``--landing`` holds one folder per entity with one JSON object per line, and
``audit`` with audit contexts; folders that are missing have nothing to land.
"""

from __future__ import annotations

import argparse

from slotledger import schemas as S
from slotledger.plans.pipeline import Warehouse
from slotledger.session import build_session
from slotledger.sources.raw import read_landing

ENTITIES = [*S.DIMENSION_ENTITIES, *S.DOCUMENT_ENTITIES, S.AUDIT_CONTEXTS, *S.AUDIT_ENTITIES]


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="slotledger", description="Run the daily pipeline.")
    parser.add_argument("--landing", required=True, help="folder with one folder per entity")
    parser.add_argument("--root", required=True, help="folder of the warehouse tables")
    parser.add_argument("--as-of", help="reporting day, YYYY-MM-DD; today when left out")
    parser.add_argument("--entities", nargs="*", default=ENTITIES, help="entities that landed")
    parser.add_argument("--full-refresh", action="store_true", help="rebuild the typed tables")
    parser.add_argument(
        "--strict", action="store_true", help="drop documents re-sent without positions"
    )
    chosen = parser.parse_args(arguments)
    spark = build_session()
    folders = {entity: f"{chosen.landing}/{entity}" for entity in chosen.entities}
    warehouse = Warehouse(spark, chosen.root, chosen.as_of)
    warehouse.run(read_landing(spark, folders), chosen.full_refresh, chosen.strict)


if __name__ == "__main__":
    main()
