import json

import pytest

from slaflow.contract import (
    column_names,
    default_contract,
    integer_columns,
    java_timestamp_pattern,
    load_contract,
)
from slaflow.sources.bronze import bronze_columns
from slaflow.sources.requests import REQUEST_COLUMNS


def test_contract_columns_in_source_order():
    assert column_names(default_contract()) == REQUEST_COLUMNS
    assert integer_columns(default_contract()) == ["sla_target_minutes", "resolution_minutes", "reopened_count"]


def test_contract_round_trips_through_json(tmp_path):
    path = tmp_path / "contract.json"
    path.write_text(json.dumps(default_contract()))
    assert load_contract(path) == default_contract()


def test_loader_rejects_incomplete_contract(tmp_path):
    path = tmp_path / "broken.json"
    path.write_text(json.dumps({"contract_name": "x"}))
    with pytest.raises(ValueError, match="missing required keys"):
        load_contract(path)


def test_no_personal_data_columns_in_bronze():
    forbidden = set(default_contract()["safety"]["forbidden_columns"])
    assert forbidden.isdisjoint(bronze_columns())


def test_timestamp_pattern_translation():
    assert java_timestamp_pattern(default_contract()["timestamp_format"]) == "yyyy-MM-dd'T'HH:mm:ss'Z'"
    with pytest.raises(ValueError):
        java_timestamp_pattern("%d/%b/%Y")
