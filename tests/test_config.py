"""Argument handling and constants (no Spark)."""

import datetime as dt

import pytest

from trialscope import config as C
from trialscope.sources import nct_id_predicates, read_jdbc_tables


def test_phase_map_covers_every_standard_label():
    assert set(C.PHASE_SPELLINGS) | {C.UNKNOWN_PHASE} == set(C.PHASE_ORDER)
    spellings = [s for group in C.PHASE_SPELLINGS.values() for s in group]
    assert len(spellings) == len(set(spellings)) == 20


def test_status_orders_share_the_same_set():
    assert set(C.MATRIX_STATUS_ORDER) == set(C.CHART_STATUS_ORDER)
    assert set(C.ACTIVE_STATUSES) < set(C.MATRIX_STATUS_ORDER)


@pytest.mark.parametrize("value,default,cap,want", [
    (None, 12, 50, 12), ("", 12, 50, 12), ("abc", 12, 50, 12), (0, 12, 50, 12),
    (3.7, 20, 100, 3), (-5, 12, 50, 1), (500, 12, 50, 50), ("7", 12, 50, 7),
    (float("nan"), 12, 50, 12), (float("inf"), 12, 50, 50), (0.5, 12, 50, 1),
])
def test_clamp_top_n(value, default, cap, want):
    assert C.clamp_top_n(value, default, cap) == want


def test_js_trim_strips_unicode_spaces():
    assert C.js_trim(" ﻿ Acme 　\n") == "Acme"
    assert C.js_trim(None) == ""
    assert C.js_trim("a​b") == "a​b"  # zero-width space is not white space


def test_sponsor_request_precedence():
    assert C.parse_sponsor_request(" A , ,B ", "C", '{"sponsors": ["D"]}') == ["A", "B"]
    assert C.parse_sponsor_request("", "C, D", '{"sponsors": ["E"]}') == ["C", "D"]
    assert C.parse_sponsor_request(None, " , ", '{"sponsors": [" E ", ""], "sponsor": "F"}') == ["E"]
    assert C.parse_sponsor_request(None, None, '{"sponsor": " F "}') == ["F"]
    assert C.parse_sponsor_request(None, None, "not json") == []
    assert C.parse_sponsor_request(None, None, '["x"]') == []


def test_as_name_list():
    assert C.as_name_list(None) == []
    assert C.as_name_list("a, b,,") == ["a", "b"]
    assert C.as_name_list([" a ", "", "b, c"]) == ["a", "b, c"]  # a list keeps commas


def test_argument_checks():
    assert C.check_months("3") == 3 and C.check_months(0) == 0
    with pytest.raises(ValueError):
        C.check_months("x")
    with pytest.raises(ValueError):
        C.check_date_column("start_date; drop table x")
    assert C.check_asof("2024-11-30") == dt.date(2024, 11, 30)
    assert C.check_asof(dt.datetime(2024, 11, 30, 5)) == dt.date(2024, 11, 30)
    assert C.check_asof(None) is None


def test_nct_id_predicates_partition_the_key_space():
    preds = nct_id_predicates(["NCT02", "NCT04"])
    assert preds == ["nct_id < 'NCT02'", "nct_id >= 'NCT02' AND nct_id < 'NCT04'",
                     "nct_id >= 'NCT04'", "nct_id IS NULL"]
    with pytest.raises(ValueError):
        nct_id_predicates(["B", "A"])


def test_horizon_from_env():
    assert C.horizon_from_env("X", 12, {}) == 12
    assert C.horizon_from_env("X", 12, {"X": "6"}) == 6
    with pytest.raises(ValueError):
        C.horizon_from_env("X", 12, {"X": "six"})


@pytest.mark.parametrize("value,want", [
    ("1_000", 12), ("inf", 12), ("infinity", 12), ("Infinity", 50), ("-Infinity", 1), ("0x10", 16), ("-0x10", 12),
    ("0b11", 3), ("0o17", 15), (" 7\u00a0", 7), ("1e1", 10), (".9e1", 9), ("5.", 5), ("5px", 12), (True, 1)])
def test_clamp_top_n_reads_numbers_as_javascript_does(value, want):
    assert C.clamp_top_n(value, 12, 50) == want


def test_json_request_values_become_text():
    assert C.parse_sponsor_request(None, None, '{"sponsors": [true, 1.0, 1.5, null, "A"]}') == ["true", "1", "1.5", "A"]


def test_bounds_are_safe_in_any_collation():
    for bad in (["nct01"], ["NCT-1"], ["NCT é"]):
        with pytest.raises(ValueError):
            nct_id_predicates(bad)


def test_unbounded_jdbc_reads_must_be_asked_for():
    with pytest.raises(ValueError, match="one_connection"):
        read_jdbc_tables(None, "jdbc:postgresql://localhost/x", {})
