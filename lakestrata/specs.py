"""Declarative registries: landing tables, Gold objects and the declared quality checks.

Unknown names raise ``ValueError``; :func:`assert_consistent` cross-checks the registries against
the rule and builder maps (the reference's registry tests, as one assertion).
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    """A landing table: its name (also its folder under the landing root) and its CSV read options."""

    name: str
    csv_options: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class GoldSpec:
    name: str
    sources: tuple[str, ...]
    # published layout of the dated facts: one Hive-style directory per month of this date column,
    # named by the layout column ``<date column>_mes`` (first day of the month); a filter on that
    # column prunes whole directories. Month, not day: a day per directory gave thousands of tiny
    # directories at small scale, and the listing and file overhead dominated every read
    partition_month_of: str | None = None

    @property
    def partition_column(self) -> str | None:
        return f"{self.partition_month_of}_mes" if self.partition_month_of else None


@dataclass(frozen=True)
class Check:
    """One declared check. ``kind`` is one of :data:`CHECK_KINDS`."""

    kind: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    lo: float | int | None = None
    hi: float | int | None = None
    ref_table: str | None = None
    minimum: int | None = None
    ref_layer: str = "silver"
    cast_type: str | None = None
    ref_column: str | None = None  # SQL expression over the reference table when it is not the column itself

    @property
    def column(self) -> str:
        return self.columns[0]

    # fixed values: the names of the checks
    @property
    def name(self) -> str:
        k = self.kind
        if k == "row_count_min":
            return f"row_count_min>={self.minimum}"
        if k == "unique":
            return "unique:" + "+".join(self.columns)
        if k == "range":
            return f"range:{self.column}[{self.lo},{self.hi}]"
        if k == "row_count_equals_source":
            return f"row_count_equals_source:{self.ref_table}"
        if k == "referential":
            return f"referential:{self.column}->{self.ref_table}"
        if k == "cast_audit":
            return f"cast_audit:{self.column}:{self.cast_type}"
        return f"{k}:{self.column}"


CHECK_KINDS = ("row_count_min", "not_null", "unique", "accepted_values", "range",
               "row_count_equals_source", "referential", "cast_audit")


# ---- fixed values: landing tables and their CSV options -----------------------------
MULTILINE_CSV = {"multiLine": "true", "quote": '"', "escape": '"'}
TABLES = [
    TableSpec("customers"),
    TableSpec("orders"),
    TableSpec("items"),
    TableSpec("payments"),
    TableSpec("reviews", MULTILINE_CSV),
    TableSpec("products"),
    TableSpec("sellers"),
    TableSpec("geolocation"),
    TableSpec("category_name"),
]

# ---- fixed values: Gold objects and the Silver tables each one reads --------------------------------
GOLD_OBJECTS = [
    GoldSpec("dim_cliente", ("customers",)),
    GoldSpec("dim_produto", ("products", "category_name")),
    GoldSpec("dim_vendedor", ("sellers",)),
    GoldSpec("dim_tempo", ("orders",)),
    GoldSpec("fato_pedidos_itens", ("orders", "items"), partition_month_of="data_pedido"),
    GoldSpec("fato_pagamentos", ("payments",)),
    GoldSpec("fato_avaliacoes", ("reviews",), partition_month_of="data_avaliacao"),
]

# ---- fixed values: accepted order statuses -----------------------------------------------------------
ORDER_STATUSES = ("delivered", "shipped", "canceled", "unavailable", "invoiced", "processing", "created",
                  "approved")


def _nn(*cols):
    return [Check("not_null", (c,)) for c in cols]


def _rng(col, lo, hi):
    return Check("range", (col,), lo=lo, hi=hi)


def _ref(col, table):
    return Check("referential", (col,), ref_table=table)


# ---- fixed values: declared checks per layer and table (9 bronze, 25 silver, 21 gold) ----------------
CHECKS: dict[str, dict[str, list[Check]]] = {
    "bronze": {t.name: [Check("row_count_min", minimum=1)] for t in TABLES},
    "silver": {
        "customers": _nn("customer_id", "customer_unique_id") + [Check("unique", ("customer_id",))],
        "orders": _nn("order_id", "customer_id") + [
            Check("unique", ("order_id",)),
            Check("accepted_values", ("order_status",), values=ORDER_STATUSES),
        ],
        "items": _nn("order_id", "product_id", "seller_id") + [
            Check("unique", ("order_id", "order_item_id")),
            _rng("price", 0, None),
            _rng("freight_value", 0, None),
        ],
        "payments": _nn("order_id", "payment_type") + [_rng("payment_value", 0, None)],
        "reviews": _nn("review_id", "order_id") + [_rng("review_score", 1, 5)],
        "products": _nn("product_id") + [Check("unique", ("product_id",))],
        "sellers": _nn("seller_id") + [Check("unique", ("seller_id",))],
        "geolocation": _nn("geolocation_zip_code_prefix"),
        "category_name": _nn("product_category_name"),
    },
    "gold": {
        "dim_cliente": [Check("unique", ("customer_id",))],
        "dim_produto": [Check("unique", ("product_id",))],
        "dim_vendedor": [Check("unique", ("seller_id",))],
        "dim_tempo": [Check("unique", ("data",))],
        "fato_pedidos_itens": _nn("order_id", "product_id", "seller_id", "customer_id") + [
            Check("unique", ("order_id", "order_item_id")),
            _rng("price", 0, None),
            _rng("freight_value", 0, None),
            Check("row_count_equals_source", ref_table="items"),
            _ref("product_id", "products"),
            _ref("seller_id", "sellers"),
            _ref("customer_id", "customers"),
        ],
        "fato_pagamentos": _nn("order_id") + [_rng("payment_value", 0, None),
                                              Check("row_count_equals_source", ref_table="payments")],
        "fato_avaliacoes": _nn("order_id") + [_rng("review_score", 1, 5),
                                              Check("row_count_equals_source", ref_table="reviews")],
    },
}

# Opt-in checks the reference leaves out (uniqueness of the translation key, which guards the
# dim_produto join against fan-out, and the dates of the item fact, held against the orders of Silver: a
# check never reads another object of the layer that is being published).
EXTRA_CHECKS: dict[str, dict[str, list[Check]]] = {
    "silver": {"category_name": [Check("unique", ("product_category_name",))]},
    "gold": {"fato_pedidos_itens": [Check("referential", ("data_pedido",), ref_table="orders",
                                          ref_column="to_date(order_purchase_timestamp)")]},
}


def table_spec(name: str) -> TableSpec:
    for t in TABLES:
        if t.name == name:
            return t
    raise ValueError(f"unknown table {name!r}; known: {[t.name for t in TABLES]}")


def gold_spec(name: str) -> GoldSpec:
    for g in GOLD_OBJECTS:
        if g.name == name:
            return g
    raise ValueError(f"unknown gold object {name!r}; known: {[g.name for g in GOLD_OBJECTS]}")


def declared_checks(layer: str, table: str, extra: bool = False) -> list[Check]:
    """Checks declared for ``(layer, table)``; an undeclared table has none (``[]``)."""
    out = list(CHECKS.get(layer, {}).get(table, []))
    if extra:
        out += EXTRA_CHECKS.get(layer, {}).get(table, [])
    return out


def assert_consistent() -> None:
    """Every table has a Silver rule, every object a builder, every source and check target exists."""
    from lakestrata.operators.gold import STARS
    from lakestrata.operators.silver import SILVER_RULES

    names = {t.name for t in TABLES}
    assert names == set(SILVER_RULES), (names, set(SILVER_RULES))
    assert {g.name for g in GOLD_OBJECTS} == set(STARS)
    for g in GOLD_OBJECTS:
        assert set(g.sources) <= names, g
    assert set(CHECKS["bronze"]) <= names and set(CHECKS["silver"]) <= names
    assert set(CHECKS["gold"]) <= {g.name for g in GOLD_OBJECTS}
    for layer in CHECKS.values():
        for checks in layer.values():
            for c in checks:
                assert c.kind in CHECK_KINDS, c
                if c.ref_table and c.ref_layer == "silver":
                    assert c.ref_table in names, c
