"""Saved views, selections, deliveries; facts of several fields that agree or not; mended faults."""

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import consistency, residue
from shelfwise.operators import temporal
from shelfwise.operators.commits import CommitConflict
from shelfwise.operators.views import Views, members_digest
from shelfwise.plans.text_queries import most_similar

ROWS = [("3", "lamp", 5.0), ("1", "lamp", 9.0), ("2", "chair", 7.0), ("10", "lamp", None)]


@pytest.fixture
def store(spark, tmp_path):
    return Views(spark, f"file://{tmp_path}/store")


def catalogue(spark):
    return spark.createDataFrame(ROWS, "sku string, name string, current_price double").withColumns({"status": F.lit("CURRENT"), "canonical_id": F.lit("x")})


def test_views_are_made_changed_and_deleted(spark, store):
    assert store.list().count() == 0 and store.get("none") is None
    one, two = store.create("b", {"keyword": " Lamp "}, "first"), store.create("a", {"statuses": "missing"}, is_system=True)
    assert [r["view_id"] for r in store.list().collect()] == [two, one]
    view = store.get(one)
    assert view["query"] == {"keyword": "lamp", "statuses": ["current"]} or view["query"]["keyword"] == "lamp"
    store.update(one, name="c", query={"keyword": "chair"})
    new = store.get(one)
    assert new["name"] == "c" and new["description"] == "first" and new["query"]["keyword"] == "chair" and new["query_hash"] != view["query_hash"] and new["created_at"] == view["created_at"]
    with pytest.raises(KeyError):
        store.update("none", name="x")
    store.delete(two)  # a view of the system stays
    store.delete(one)
    store.delete("none")
    assert [r["view_id"] for r in store.list().collect()] == [two]


def test_a_selection_is_whole_frozen_and_outlives_its_view(spark, store):
    view = store.create("lamps", {"keyword": "lamp"})
    chosen = store.select("lamps of today", catalogue(spark), {"keyword": "lamp", "limit": 1, "offset": 1}, "commit-1", view)
    assert [(r["ordinal"], r["sku"]) for r in store.members(chosen).orderBy("ordinal").collect()] == [(1, "1"), (2, "10"), (3, "3")]
    before = members_digest(store.members(chosen))
    store.delete(view)
    row = store.selections.read().first()
    assert (row["selection_id"], row["view_id"], row["matched"], row["source_commit"]) == (chosen, None, 3, "commit-1")
    assert members_digest(store.members(chosen)) == before
    empty = store.select("none", catalogue(spark), {"keyword": "no such"})
    assert store.members(empty).count() == 0


def test_deliveries_are_only_added(spark, store):
    first = store.deliver("CSV", "out.csv", 3, "d1", "sel_1", artifact_id="same")
    second = store.deliver("CSV", "out.csv", 4, "d2", "sel_1", artifact_id="same")
    store.deliver("ZIP", "out.zip", 0, None, "sel_2", "FAILED", "no images")
    assert first == "same" and second.startswith("same_")
    assert {(r["artifact_id"], r["rows"]) for r in store.delivered("sel_1").collect()} == {(first, 3), (second, 4)}
    assert store.delivered().count() == 3


def test_two_writers_on_one_head_do_not_both_win(spark, store, monkeypatch):
    store.create("a", {})
    stale = store.views.head().commit_id
    store.create("b", {})
    with pytest.raises(CommitConflict):
        store.views.commit(store.list(), "late", stale)
    assert store.list().count() == 2


FLAGS = [
    ({"spec": "2 kg", "details": "Peso: 2 kg", "description": "de 2,0 KG"}, []),
    ({"spec": "2 kg", "details": "Peso: 2000 g"}, ["NUMERIC_CONFLICT", "UNIT_CONFLICT"]),
    ({"spec": "2 kg", "details": "Alto: 3 cm"}, []),
    ({"details": "Alto: 3 cm; alto: 4 cm"}, ["NUMERIC_CONFLICT"]),
    ({"spec": "Talla M/L", "details": "talla: m / l"}, []),
    ({"spec": "Talla: 36-40", "details": "Tamaño 41"}, ["SIZE_RANGE_CONFLICT"]),
    ({"name": "x", "description": "Producto: Vela.", "details": "Tipo de artículo: vela; Material: Algodón", "spec": "material: algodon"}, []),
    ({"description": "Producto: Vela", "details": "Producto: Silla; Material: Cera; Material: Lino"}, ["MATERIAL_CONFLICT", "PRODUCT_OBJECT_CONFLICT"]),
    ({"name": "Marca: A", "cat1": "marca：B", "details": "Modelo: X1; modelo\tX2"}, ["BRAND_CONFLICT", "MODEL_CONFLICT"]),
    ({"spec": None, "details": None}, []),
]


def test_fields_that_contradict_each_other(spark):
    schema = ", ".join(f"{f} string" for f in consistency.FIELDS)
    rows = spark.createDataFrame([tuple(own.get(f) for f in consistency.FIELDS) for own, _ in FLAGS], schema)
    got = rows.select(consistency.consistency_flags({f: F.col(f) for f in consistency.FIELDS})).collect()
    assert [r[0] for r in got] == [want for _, want in FLAGS]


def test_issues_of_a_source(spark):
    rows = spark.createDataFrame([("n", "c", "d", "s", "x <b>", "Número del artículo: 12"), ("n", "c", "d", "s", "中", "Numero del articulo 13"), ("n", " ", "d", "null", "x", "y")], ", ".join(f"{f} string" for f in consistency.FIELDS))
    got = [r[0] for r in rows.select(consistency.quality_issues({f: F.col(f) for f in consistency.FIELDS}, F.lit("12"))).collect()]
    assert got == [["POLLUTED_DESCRIPTION"], ["DETAIL_SKU_MISMATCH", "POLLUTED_DESCRIPTION"], ["DETAIL_SKU_MISSING", "EMPTY_CAT1", "POLLUTED_SPEC"]]


def test_candidates_can_be_bounded_and_calendars_are(spark, monkeypatch):
    items = spark.createDataFrame([(k, ["all", f"t{k % 3}", f"u{k % 2}"]) for k in range(12)], "item_id long, w array<string>")
    plain = {}
    sets = {k: {"all", f"t{k % 3}", f"u{k % 2}"} for k in range(12)}
    for k in sets:
        scored = sorted((-len(sets[k] & sets[o]) / len(sets[k] | sets[o]), o) for o in sets if o != k and o >= 8)
        plain[k] = [o for _, o in scored[:2]]
    got = {}
    for r in most_similar(items, 2, newest=4).orderBy("item_id", F.desc("similarity"), "other").collect():
        got.setdefault(r["item_id"], []).append(r["other"])
    assert got == plain
    monkeypatch.setattr(temporal, "MOST_DAYS", 2)
    days = spark.createDataFrame([(d, True) for d in ("a", "b", "c")], "day string, complete boolean")
    with pytest.raises(ValueError, match="calendar"):
        temporal.presence_history(days.select(F.col("day").alias("sku")), days, days.select("day", F.col("day").alias("sku")))


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "x string").select(column(F.col("x"))).first()[0]


def test_words_left_of_the_source(spark):
    brands = F.array(F.lit("Philips"))
    words = lambda t: one(spark, t, lambda c: residue.ordinary_words(c, brands))
    assert words("LED USB-C Philips XL 灯 https://shop.example/lamp x") == [] and words("红色 lámpara de LED A4") == ["lámpara", "de"] and words(None) == []
    kinds = spark.createDataFrame([("Philips",), ("E27",), ("AB-1X",), ("vela",), ("W5000",)], "x string").select(residue.latin_class(F.col("x"), brands)).collect()
    assert [r[0] for r in kinds] == ["BRAND_TOKEN", "TECH_TOKEN", "MODEL_TOKEN", "ORDINARY_WORD", "TECH_TOKEN"]
    left = [(t, one(spark, t, residue.is_untranslated)) for t in ("", "Philips W5", "lámpara", "灯 lámpara", "pack 3", "empacado", "Juego DE té")]
    assert [t for t, bad in left if bad] == ["lámpara", "pack 3", "Juego DE té"]
    assert one(spark, " a\u00a0\tb\n\n××  c ", residue.target_text) == "a b × c"


def test_numbers_in_digits_words_and_signs(spark):
    numbers = lambda t: one(spark, t, residue.number_multiset)
    assert numbers("3 x 2,50 cm, 007 y 10.0") == ["10", "2.5", "3", "7"]
    assert numbers("dos piezas y tres pequeñas cajas; treinta y cinco rollos; cuatro amigos; 3D") == ["2", "3"]
    assert numbers("三合一 两件 五金 一种 三种 3/四 内裤/三角裤") == ["1", "2", "3", "3", "3", "4"]
    assert numbers(None) == [] and numbers("ciento dos piezas") == []


def test_rules_over_metrics_at_their_borders(spark):
    from shelfwise.operators import quality as q

    rows = [("a", "m", 85.0, 100.0), ("b", "m", 85.01, 100.0), ("c", "m", 92.1, 100.0), ("d", "m", 1.0, None), ("e", "m", None, 100.0), ("f", "m", 5.0, 0.0), ("g", "share", 0.5, 0.625), ("h", "share", 0.5625, 0.625), ("i", "low", 0.98, None), ("j", "low", 0.97, None), ("k", "high", 0.0, None), ("l", "high", 0.1, None), ("n", "least", 0.9, None)]
    rules = (("m", "DROP_PERCENT", 15.0, "BLOCK", "M"), ("m", "DROP_PERCENT", 8.0, "WARN", "M"), ("share", "DROP_POINTS", 10.0, "HIGH", "S"), ("low", "BELOW", 0.98, "REVIEW", "L"), ("high", "ABOVE", 0.0, "HIGH", "H"), ("least", "AT_LEAST", 0.9, "HIGH", "E"))
    values = spark.createDataFrame(rows, "run string, metric string, value double, median_7 double")
    found = q.rule_findings(values, ["run"], rules)
    assert {(r["run"], r["code"], r["level"]) for r in found.collect()} == {("a", "M", "BLOCK"), ("b", "M", "WARN"), ("g", "S", "HIGH"), ("j", "L", "REVIEW"), ("l", "H", "HIGH"), ("n", "E", "HIGH")}
    states = {r["run"]: r["state"] for r in q.gate_states(found, ["run"], values).collect()}
    assert states["a"] == "COLLECTION_BLOCKED" and states["b"] == "COLLECTION_WARN" and states["c"] == "COLLECTION_OK"


def test_absences_count_by_the_category_of_yesterday(spark):
    rows = spark.createDataFrame([(s, False) for s in "abcde"] + [("p", True)], "sku string, present boolean")
    cover = spark.createDataFrame([(" Toys", True), ("toys ", False), ("Food", False), ("", True), (None, True)], "category string, complete boolean")
    before = spark.createDataFrame([("a", "TOYS"), ("b", "Food"), ("c", " "), ("p", "Food")], "sku string, category string")
    known = spark.createDataFrame([("b", "Toys"), ("c", "Toys"), ("d", "toys")], "sku string, category string")
    states = lambda valid: {r["sku"]: r["presence_state"] for r in temporal.valid_absences(rows, cover, before, known, valid).collect()}
    assert states(False) == {"a": "ABSENT", "b": "UNKNOWN", "c": "UNKNOWN", "d": "ABSENT", "e": "UNKNOWN", "p": "PRESENT"}
    assert set(states(True).values()) == {"ABSENT", "PRESENT"}
