import pytest

from lakestrata import specs
from lakestrata.operators.gold import STARS
from lakestrata.operators.silver import SILVER_RULES


def test_registries_are_consistent():
    specs.assert_consistent()


def test_every_table_has_a_silver_rule():
    assert {t.name for t in specs.TABLES} == set(SILVER_RULES)


def test_every_gold_object_has_a_builder_and_known_sources():
    assert {g.name for g in specs.GOLD_OBJECTS} == set(STARS)
    names = {t.name for t in specs.TABLES}
    for g in specs.GOLD_OBJECTS:
        assert set(g.sources) <= names


def test_declared_check_totals():
    per_layer = {layer: sum(len(c) for c in tables.values()) for layer, tables in specs.CHECKS.items()}
    assert per_layer == {"bronze": 9, "silver": 25, "gold": 21}


def test_reviews_read_with_multiline_options():
    assert specs.table_spec("reviews").csv_options == {"multiLine": "true", "quote": '"', "escape": '"'}
    assert specs.table_spec("orders").csv_options == {}


def test_unknown_names_raise():
    with pytest.raises(ValueError):
        specs.table_spec("nope")
    with pytest.raises(ValueError):
        specs.gold_spec("nope")


def test_undeclared_table_has_no_checks():
    assert specs.declared_checks("silver", "nope") == []
    assert specs.declared_checks("landing", "customers") == []


def test_check_names():
    c = specs.CHECKS["gold"]["fato_pedidos_itens"]
    names = [x.name for x in c]
    assert "unique:order_id+order_item_id" in names
    assert "range:price[0,None]" in names
    assert "referential:product_id->products" in names
    assert "row_count_equals_source:items" in names
    assert specs.CHECKS["bronze"]["orders"][0].name == "row_count_min>=1"


def test_extra_checks_are_opt_in():
    base = specs.declared_checks("silver", "category_name")
    extra = specs.declared_checks("silver", "category_name", extra=True)
    assert len(extra) == len(base) + 1 and extra[-1].name == "unique:product_category_name"
