"""The sample tables (line items, parts, orders, events, ...) seen as a slot ledger.

Every line item is a document position: its order is the document, its supplier
the slot, its part's brand the item, its day of shipment the day. The mapping is
written out in ``FIXTURES.md``; ``oracle.py`` states the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotledger import schemas as S
from slotledger.operators import ledger as L
from slotledger.operators.ids import with_global_ids
from slotledger.session import cut

AS_OF = "2001-12-31"  # after the last shipment
POSITIONS_PER_PAGE = 500  # the most positions one JSON object carries

# One order that tells any two postings apart.
POSTING_ORDER = [
    "doc_id", "item_id", "op_type", "number", "l_partkey", "l_suppkey", "l_extendedprice",
    "quantity", "doc_type", "moment", "slot_id", "agent_id",
]
LEDGER_COLUMNS = [
    "id", "doc_id", "applicable", "moment", "number", "agent_id", "store_id", "item_id",
    "quantity", "slot_id", "doc_type", "op_type",
]


def text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


class SampleLedger:
    """Lazily built frames over the tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._stored: dict[str, DataFrame] = {}

    def _directory(self, name: str, rows: DataFrame) -> DataFrame:
        """A directory stored once: with its size known, a small one spares the ledger a shuffle."""
        if name not in self._stored:
            self._stored[name] = cut(rows, name)
        return self._stored[name]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def doc_type(self) -> Column:
        flag, status = F.col("l_returnflag"), F.col("l_linestatus")
        return (
            F.when(flag == "R", "move")
            .when((flag == "N") & (status == "O"), "supply")
            .when((flag == "A") & (status == "O"), "enter")
            .when(flag == "N", "demand")
            .otherwise("loss")
        )

    def moment(self) -> Column:
        return F.col("l_shipdate").cast(S.TIME)

    def base(self) -> DataFrame:
        """All line items with their part's brand and their order."""
        shipped = self.table("lineitem")
        parts = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        orders = self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus", "o_custkey"
        )
        return shipped.join(parts, "l_partkey").join(orders, "l_orderkey").select(
            F.col("l_orderkey").alias("doc_id"),
            (F.col("o_orderstatus") != "P").alias("applicable"),
            self.moment().alias("moment"),
            F.col("l_linenumber").alias("number"),
            "o_custkey",
            (F.col("l_suppkey") % 3).alias("store_id"),
            F.col("p_brand").alias("item_id"),
            "l_quantity", "l_tax", "l_linestatus",
            self.doc_type().alias("doc_type"),
            "l_partkey", "l_suppkey", "l_extendedprice",
        )

    def legs(self, base: DataFrame) -> DataFrame:
        """Signed postings: one per row, for a move one out of a slot and one into another."""
        slot, amount = F.col("l_suppkey"), F.col("l_quantity")
        inward = F.col("l_linestatus") == "O"

        def leg(quantity: Column, slot_id: Column, op_type: Column, agent: Column) -> Column:
            return F.struct(
                quantity.alias("quantity"),
                slot_id.alias("slot_id"),
                op_type.alias("op_type"),
                agent.alias("agent_id"),
            )

        nobody = F.lit(None).cast("bigint")
        moved = F.array(
            leg(-amount, text(slot), F.lit("out"), nobody),
            leg(amount, text(slot + 3), F.lit("in"), nobody),
        )
        posted = F.array(
            leg(
                F.when(inward, amount).otherwise(-amount),
                F.when(F.col("l_tax") != 0, text(slot)),
                F.when(inward, "in").otherwise("out"),
                F.col("o_custkey"),
            )
        )
        rows = F.when(F.col("doc_type") == "move", moved).otherwise(posted)
        return (
            base.withColumn("leg", F.explode(rows))
            .select("*", "leg.*")
            .drop("leg", "o_custkey", "l_quantity", "l_tax", "l_linestatus")
        )

    def documents(self) -> dict[str, DataFrame]:
        """The five kinds of documents as frames of their own."""
        base = self.base()
        return {
            kind: self.legs(base.filter(F.col("doc_type") == kind))
            for kind in S.DOCUMENT_ENTITIES
        }

    def operations_all(self) -> DataFrame:
        """The whole ledger, from one pass over the line items."""
        united = self.legs(self.base())
        kept = [c for c in LEDGER_COLUMNS if c != "id"]
        return L.unify_operations([united], POSTING_ORDER, kept).select(*LEDGER_COLUMNS)

    def items(self) -> DataFrame:
        """Brands as items; their number decides on depositor and expected quantity."""
        number = F.replace("p_brand", F.lit("Brand#"), F.lit("")).cast("int")
        owner = number % 4
        brands = self.table("part").groupBy("p_brand").agg(
            F.min("p_type").alias("article"), F.max("p_size").cast("double").alias("weight")
        )
        rows = brands.select(
            F.col("p_brand").alias("item_id"),
            owner.alias("depositor_id"),
            F.when(number % 5 != 0, F.lit(25.0)).alias("expected_bin_qty"),
            F.concat(F.lit("Item "), "p_brand").alias("name"),
            F.lit(None).cast(S.TIME).alias("updated"),
            F.lit(None).cast("string").alias("product"),
            F.lit(None).cast("string").alias("lot"),
            F.lit(None).cast("string").alias("mfg_date"),
            "article",
            "weight",
            F.lit(None).cast("double").alias("volume"),
            F.lit("pcs").alias("uom"),
            F.when(owner == 0, S.OWN_STOCK)
            .otherwise(F.concat(F.lit("DEP_"), text(owner)))
            .alias("depositor_name"),
            F.concat(F.lit("INN"), text(owner)).alias("depositor_inn"),
        )
        return self._directory("items", rows)

    def audit_events(self) -> DataFrame:
        """Errors as deletions and sign-ups as restorations of the order with the user's number."""
        kinds = F.when(F.col("event_type") == "error", S.EVENT_DELETED).when(
            F.col("event_type") == "signup", S.EVENT_RESTORED
        )
        return self.table("events").filter(F.col("event_type").isin("error", "signup")).select(
            F.col("user_id").alias("doc_id"),
            F.lit("order").alias("entity_type"),
            kinds.alias("event_type"),
            text("event_id").alias("name"),
            F.col("ts").alias("moment"),
        )

    def audit_sides(self) -> list[DataFrame]:
        events = self.audit_events()
        return [
            events.filter(F.col("event_type") == kind)
            for kind in (S.EVENT_DELETED, S.EVENT_RESTORED)
        ]

    def hidden(self) -> DataFrame:
        """Documents whose last event leaves them out, stored once: few of them spare the ledger a shuffle."""
        last = L.last_events(*self.audit_sides()).select("doc_id", "status")
        return self._directory("hidden", last.filter(F.col("status") != S.STATUS_ACTIVE))

    def operations(self, ledger: DataFrame | None = None) -> DataFrame:
        everything = self.operations_all() if ledger is None else ledger
        return L.filter_operations(everything, self.items(), self.hidden())

    def split(self) -> DataFrame:
        return L.split_movements(self.operations())

    def movements(self) -> DataFrame:
        """As ``split``, without row numbers: what daily figures are made of."""
        slotted = self.legs(self.base()).withColumn(
            "slot_id", F.coalesce("slot_id", F.lit(S.OFF_SLOT))
        )
        return L.split_movements(self.operations(slotted))

    def slot_directory(self) -> DataFrame:
        return self.table("supplier").select(
            text("s_suppkey").alias("slot_id"),
            F.col("s_nationkey").alias("zone_id"),
            F.col("s_name").alias("name"),
        )

    def zones(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("zone_id"), F.col("n_name").alias("name")
        )

    def slots(self) -> DataFrame:
        return self._directory("slots", L.named_slots(self.slot_directory(), self.zones()))

    def agents(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("agent_id"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("inn"),
        )

    def stores(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").cast("bigint").alias("store_id"), F.col("r_name").alias("name")
        )

    def operations_with_balance(self) -> DataFrame:
        return L.operations_with_balance(
            self.operations(), self.items(), self.slots(), self.agents(), self.stores()
        )

    # --- the same rows as landed JSON --------------------------------------

    def raw_documents(self) -> DataFrame:
        """All line items as JSON documents, grouped under their order, kind and store.

        Rows are numbered first and a document is sent in pages, so no object
        holds more than ``POSITIONS_PER_PAGE`` positions whatever the order's size.
        """
        lines = self.table("lineitem").withColumn("kind", self.doc_type())
        order = [
            "l_orderkey", "kind", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_shipdate",
        ]
        kept = ["l_orderkey", "kind", "l_partkey", "l_suppkey", "l_quantity", "l_tax"]
        numbered = with_global_ids(lines.select(*order), [F.col(c).asc_nulls_last() for c in order], keep=kept)
        orders = self.table("orders")
        joined = numbered.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

        def ref(value: Column) -> Column:
            return F.struct(text(value).alias("id"))

        slot = F.when(F.col("l_tax") != 0, ref(F.col("l_suppkey")))
        moved = F.col("kind") == "move"
        position = F.struct(
            "id",
            F.col("l_quantity").alias("quantity"),
            ref(F.col("l_partkey")).alias("assortment"),
            F.when(~moved, slot).alias("slot"),
            F.when(moved, ref(F.col("l_suppkey"))).alias("sourceSlot"),
            F.when(moved, ref(F.col("l_suppkey") + 3)).alias("targetSlot"),
        )
        page = F.floor(F.col("id") / POSITIONS_PER_PAGE)
        header = [
            "kind", "l_orderkey", "o_orderstatus", "o_orderdate", "o_custkey",
            (F.col("l_suppkey") % 3).alias("store"), page.alias("page"),
        ]
        documents = joined.groupBy(*header).agg(
            F.array_sort(F.collect_list(position)).alias("rows")
        )
        time = text("o_orderdate")
        store = ref(F.col("store"))
        body = F.struct(
            text("l_orderkey").alias("id"),
            F.concat(F.lit("N"), text("l_orderkey")).alias("name"),
            time.alias("moment"),
            time.alias("updated"),
            (F.col("o_orderstatus") != "P").alias("applicable"),
            F.when(~moved, ref(F.col("o_custkey"))).alias("agent"),
            F.when(~moved, store).alias("store"),
            F.when(moved, store).alias("sourceStore"),
            F.when(moved, store).alias("targetStore"),
            F.struct("rows").alias("positions"),
        )
        return documents.select(F.col("kind").alias("entity"), F.to_json(body).alias("raw_json"))

    def raw_stores(
        self, store_changed: Column | None = None, slot_changed: Column | None = None
    ) -> DataFrame:
        """Regions as stores with nations as zones and suppliers as slots, in pages.

        Change times may be given from the columns of ``region`` and of ``supplier``.
        """
        first = F.lit("2000-01-01 00:00:00")
        store_changed = first if store_changed is None else store_changed
        slot_changed = first if slot_changed is None else slot_changed
        nations = self.table("nation")
        slot = F.struct(
            text("s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            slot_changed.alias("updated"),
            F.struct(text("n_nationkey").alias("id")).alias("zone"),
        )
        page = F.floor(F.col("s_suppkey") / POSITIONS_PER_PAGE)
        slots = (
            self.table("supplier")
            .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
            .groupBy("n_regionkey", page.alias("page"))
            .agg(F.array_sort(F.collect_list(slot)).alias("slots"))
        )
        zone = F.struct(
            text("n_nationkey").alias("id"),
            F.col("n_name").alias("name"),
            first.alias("updated"),
        )
        # Nations are a fixed list of 25, so a region's zones stay few.
        zones = nations.groupBy("n_regionkey").agg(
            F.array_sort(F.collect_list(zone)).alias("zones")
        )
        regions = self.table("region").withColumn("n_regionkey", F.col("r_regionkey"))
        head = [
            text("r_regionkey").alias("id"),
            F.col("r_name").alias("name"),
            store_changed.alias("updated"),
        ]
        with_zones = regions.join(zones, "n_regionkey").select(
            F.to_json(F.struct(*head, F.struct(F.col("zones").alias("rows")).alias("zones"))).alias(
                "raw_json"
            )
        )
        with_slots = regions.join(slots, "n_regionkey").select(
            F.to_json(F.struct(*head, F.struct(F.col("slots").alias("rows")).alias("slots"))).alias(
                "raw_json"
            )
        )
        return with_zones.unionByName(with_slots).select(F.lit("store").alias("entity"), "raw_json")

    def raw_products(self) -> DataFrame:
        """Parts as products; owner and expected quantity sit among custom fields."""

        def field(name: str, json: Column) -> Column:
            return F.struct(F.lit(name).alias("name"), F.parse_json(json).alias("value"))

        owner = F.to_json(
            F.struct(
                F.lit("owner").alias("kind"),
                F.when(F.col("p_size") > 5, text("p_partkey")).alias("id"),
            )
        )
        body = F.struct(
            text("p_partkey").alias("id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("article"),
            F.col("p_size").alias("weight"),
            F.col("p_retailprice").alias("volume"),
            F.lit("2000-01-01 00:00:00").alias("updated"),
            F.struct(text(F.col("p_size") % 7).alias("id")).alias("uom"),
            F.array(
                field("Цвет", F.lit('"red"')),
                field(S.ATTRIBUTE_DEPOSITOR, F.lit("{}")),
                field(S.ATTRIBUTE_DEPOSITOR, owner),
                field(S.ATTRIBUTE_BIN_QTY, text(F.col("p_size") * 10)),
            ).alias("attributes"),
        )
        return self.table("part").select(
            F.lit("product").alias("entity"), F.to_json(body).alias("raw_json")
        )

    def product_lots(self) -> DataFrame:
        """One lot per part and supplier, dated by its first shipment."""
        return (
            self.table("lineitem")
            .groupBy("l_partkey", "l_suppkey")
            .agg(F.min("l_shipdate").alias("first_ship"))
            .select(
                F.concat_ws("-", text("l_partkey"), text("l_suppkey")).alias("variant_id"),
                text("l_partkey").alias("product_id"),
                F.concat(F.lit("L"), text("l_suppkey")).alias("lot"),
                F.when(
                    F.col("first_ship") >= F.lit("1999-01-01").cast(S.TIME),
                    text(F.to_date("first_ship")),
                ).alias("mfg_date"),
                F.col("first_ship").alias("updated"),
            )
        )

    def raw_variants(self) -> DataFrame:
        """Lots as variants; a lot without a date has no such characteristic value."""

        def field(name: str, value: Column) -> Column:
            return F.struct(F.lit(name).alias("name"), value.alias("value"))

        body = F.struct(
            F.col("variant_id").alias("id"),
            text("updated").alias("updated"),
            F.struct(F.col("product_id").alias("id")).alias("product"),
            F.array(
                field(S.CHARACTERISTIC_MFG_DATE, F.col("mfg_date")),
                field(S.CHARACTERISTIC_LOT, F.col("lot")),
            ).alias("characteristics"),
        )
        return self.product_lots().select(
            F.lit("variant").alias("entity"), F.to_json(body).alias("raw_json")
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            text("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("article"),
            F.col("p_size").cast("double").alias("weight"),
            F.col("p_retailprice").alias("volume"),
            (F.col("p_size") % 7).alias("uom_id"),
            F.col("p_partkey").alias("depositor_id"),
            (F.col("p_size") * 10.0).alias("expected_bin_qty"),
            F.lit(None).cast(S.TIME).alias("updated"),
        )

    def uoms(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").alias("uom_id"), F.col("r_name").alias("name")
        )

    def raw_audit_contexts(self) -> DataFrame:
        """Each event as an audit context: the event itself and an unrelated update."""
        link = F.when(
            F.col("value") >= 5, F.concat(F.lit("https://host/entity/demand/"), text("user_id"))
        ).otherwise("")

        def entry(kind: Column) -> Column:
            return F.struct(
                kind.alias("eventType"),
                F.lit("demand").alias("entityType"),
                text("event_id").alias("name"),
                F.struct(F.struct(link.alias("href")).alias("meta")).alias("entity"),
            )

        kind = (
            F.when(F.col("event_type") == "error", S.EVENT_DELETED)
            .when(F.col("event_type") == "signup", S.EVENT_RESTORED)
            .otherwise(F.col("event_type"))
        )
        body = F.struct(
            text("event_id").alias("id"),
            text("ts").alias("moment"),
            F.array(entry(F.lit("update")), entry(kind)).alias("events"),
        )
        return self.table("events").select(F.to_json(body).alias("raw_json"))

    def annexed_slots(self) -> DataFrame:
        """Suppliers as slots, and the targets of moves that lie beyond them."""
        suppliers = self.table("supplier")
        targets = suppliers.select((F.col("s_suppkey") + 3).alias("s_suppkey"))
        return (
            suppliers.select("s_suppkey").union(targets).distinct()
            .join(suppliers, "s_suppkey", "left")
            .select(
                text("s_suppkey").alias("slot_id"),
                F.coalesce("s_name", F.concat(F.lit("Annex "), text("s_suppkey"))).alias("name"),
                F.col("s_nationkey").alias("zone_id"),
                F.floor(F.col("s_suppkey") / POSITIONS_PER_PAGE).alias("page"),
            )
        )

    def raw_places(self) -> DataFrame:
        """Regions as stores with nations as zones; each page of slots is a store of its own,
        so that every store is sent once."""
        changed = F.lit("2000-01-01 00:00:00").alias("updated")
        zone = F.struct(text("n_nationkey").alias("id"), F.col("n_name").alias("name"), changed)
        # Nations are a fixed list of 25.
        zones = self.table("nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(
            F.array_sort(F.collect_list(zone)).alias("rows")
        )
        regions = self.table("region").join(zones, "r_regionkey", "left").select(
            text("r_regionkey").alias("id"), F.col("r_name").alias("name"), changed,
            F.struct("rows").alias("zones"),
        )
        slot = F.struct(
            F.col("slot_id").alias("id"), "name", changed, F.struct(text("zone_id").alias("id")).alias("zone")
        )
        pages = (
            self.annexed_slots().groupBy("page").agg(F.array_sort(F.collect_list(slot)).alias("rows"))
            .select(
                F.concat(F.lit("page"), text("page")).alias("id"),
                F.concat(F.lit("Page "), text("page")).alias("name"), changed,
                F.struct("rows").alias("slots"),
            )
        )
        return regions.select(F.to_json(F.struct("*")).alias("raw_json")).union(
            pages.select(F.to_json(F.struct("*")).alias("raw_json"))
        ).select(F.lit("store").alias("entity"), "raw_json")

    def raw_ledger_documents(self, lines: DataFrame, updated: Column) -> DataFrame:
        """Line items as ``base`` maps them, as the documents a source would send."""
        order = ["doc_id", "doc_type", "moment", "number", "l_partkey", "l_suppkey",
                 "l_extendedprice", "l_quantity", "l_tax"]
        numbered = with_global_ids(lines, [F.col(c).asc_nulls_last() for c in order])
        moved = F.col("doc_type") == "move"

        def ref(value: Column) -> Column:
            return F.struct(text(value).alias("id"))

        position = F.struct(
            "id",
            F.col("l_quantity").alias("quantity"),
            ref(F.col("item_id")).alias("assortment"),
            F.when(~moved & (F.col("l_tax") != 0), ref(F.col("l_suppkey"))).alias("slot"),
            F.when(moved, ref(F.col("l_suppkey"))).alias("sourceSlot"),
            F.when(moved, ref(F.col("l_suppkey") + 3)).alias("targetSlot"),
        )
        header = [
            "doc_id", "doc_type", "moment", "applicable", "o_custkey", "store_id",
            F.floor(F.col("id") / POSITIONS_PER_PAGE).alias("page"),
        ]
        store = ref(F.col("store_id"))
        body = F.struct(
            text("doc_id").alias("id"),
            text("doc_id").alias("name"),
            text("moment").alias("moment"),
            updated.alias("updated"),
            "applicable",
            F.when(~moved, ref(F.col("o_custkey"))).alias("agent"),
            F.when(~moved, store).alias("store"),
            F.when(moved, store).alias("sourceStore"),
            F.when(moved, store).alias("targetStore"),
            F.struct("rows").alias("positions"),
        )
        return (
            numbered.groupBy(*header)
            .agg(F.array_sort(F.collect_list(position)).alias("rows"))
            .select(F.col("doc_type").alias("entity"), F.to_json(body).alias("raw_json"))
        )

    def edited_documents(self) -> DataFrame:
        """Every fiftieth order re-sent later, with double quantities."""
        lines = self.base().filter(F.col("doc_id") % 50 == 0)
        doubled = lines.withColumn("l_quantity", 2 * F.col("l_quantity"))
        return self.raw_ledger_documents(doubled, F.lit("2002-06-01 00:00:00"))

    def raw_ledger(self) -> DataFrame:
        """What ``base`` maps, as a source would send it: documents, directories, brands."""
        documents = self.raw_ledger_documents(self.base(), text("moment"))
        changed = F.lit("2000-01-01 00:00:00").alias("updated")
        owners = self.items().select("depositor_id", "depositor_name", "depositor_inn").distinct()
        agents = owners.select(
            F.concat(F.lit("owner"), text("depositor_id")).alias("id"),
            F.col("depositor_name").alias("name"),
            F.col("depositor_inn").alias("inn"),
            changed,
        )
        customers = self.agents().select(
            text("agent_id").alias("id"), "name", "inn", changed
        )

        def field(name: str, json: Column) -> Column:
            return F.struct(F.lit(name).alias("name"), F.parse_json(json).alias("value"))

        owner = F.concat(F.lit("owner"), text("depositor_id"))
        brands = self.items().select(
            F.col("item_id").alias("id"),
            "name",
            "article",
            F.struct(F.lit("pcs").alias("id")).alias("uom"),
            F.array_compact(
                F.array(
                    field(S.ATTRIBUTE_DEPOSITOR, F.to_json(F.struct(owner.alias("id")))),
                    F.when(
                        F.col("expected_bin_qty").isNotNull(),
                        field(S.ATTRIBUTE_BIN_QTY, text("expected_bin_qty")),
                    ),
                )
            ).alias("attributes"),
            changed,
        )
        units = self.spark.range(1).select(
            F.lit("pcs").alias("id"), F.lit("pcs").alias("name"), changed
        )

        def objects(entity: str, rows: DataFrame) -> DataFrame:
            return rows.select(
                F.lit(entity).alias("entity"), F.to_json(F.struct(*rows.columns)).alias("raw_json")
            )

        return (
            documents.unionByName(objects("counterparty", agents.unionByName(customers)))
            .unionByName(objects("product", brands))
            .unionByName(objects("uom", units))
            .unionByName(self.raw_places())
        )

    def raw_audit(self) -> DataFrame:
        """The audit events as a source would send them."""
        rows = self.audit_events()
        body = F.struct(
            text("doc_id").alias("doc_id"), "entity_type", "event_type", "name",
            text("moment").alias("moment"),
        )
        deleted = F.col("event_type") == S.EVENT_DELETED
        return rows.select(
            F.when(deleted, "audit_deleted").otherwise("audit_restored").alias("entity"),
            F.to_json(body).alias("raw_json"),
        )
