"""A dataset registry read from YAML: an invented one field by field, the built-in one by round trip."""

import dataclasses

import yaml

from tidemark.plans import quality as QA
from tidemark.schemas import REGISTRY, Dataset, load_registry
from tidemark.sources.warehouse import DerivedWarehouse

INVENTED = """
- {id: tides, source: GAUGE, entity: water, dimensions: [date], metrics: [sessions, users],
   freshness_ttl_minutes: 15, quality_checks: {not_null: [date], unique: [date]}}
- {id: moons}
"""


def test_invented_registry_field_by_field():
    tides, moons = load_registry(INVENTED, {"tides": "fact_sessions"})
    assert tides == Dataset("tides", "fact_sessions", "GAUGE", "water", ("date",), ("sessions", "users"), "daily", 15,
                            not_null=("date",), unique=("date",))
    assert moons == Dataset("moons", "fact_moons", "", "", (), ())


def test_builtin_registry_round_trip():
    entries = [dataclasses.asdict(d) for d in REGISTRY]
    for e in entries:
        e["quality_checks"] = {"not_null": list(e.pop("not_null")), "unique": list(e.pop("unique"))}
        e["dimensions"], e["metrics"] = list(e["dimensions"]), list(e["metrics"])
    tables = {e["id"]: e.pop("table") for e in entries}
    assert load_registry(yaml.safe_dump(entries), tables) == REGISTRY


def test_checks_follow_the_given_registry(spark):
    registry = load_registry(INVENTED, {"tides": "fact_sessions"})[:1]
    w = DerivedWarehouse(spark, "/root/testdata/sf0.001")
    assert [(r.dataset, r.column_name, r.nulls) for r in QA.check_not_null(w, registry).collect()] == [("tides", "date", 0)]
    assert [r.duplicate_keys for r in QA.check_unique(w, registry).collect()] == [0]


def test_cli_takes_a_registry(spark, tmp_path):
    from tidemark.__main__ import main
    from tidemark.operators import tables as K
    from tidemark.schemas import TABLES
    rows = [(None, None, None, 1, None)] * 2
    K.append(spark.createDataFrame(rows, TABLES["fact_sessions"]), f"{tmp_path}/fact_sessions", ["date"])
    (tmp_path / "r.yml").write_text("- {id: sessions, quality_checks: {not_null: [users], unique: [users]}}\n")
    ask = lambda q: [tuple(r) for r in main(["query", q, "--root", str(tmp_path), "--registry", str(tmp_path / "r.yml")], spark).collect()]
    assert ask("check_not_null") == [("sessions", "users", 0, 2, False)]
    assert ask("check_unique") == [("sessions", "users", 1, 2, True)]
