"""The list of analyses in COVERAGE.md names every key and only existing functions."""

from __future__ import annotations

import re
from pathlib import Path

from tallyroom.functions import text
from tallyroom.operators import keys, profile
from tallyroom.plans import game, game_sales, realty, telecom
from tallyroom.registry import queries
from tallyroom.sources import csv_file

MODULES = {
    "csv_file": csv_file, "game": game, "game_sales": game_sales, "keys": keys, "profile": profile, "realty": realty,
    "telecom": telecom, "text": text,
}


def listed() -> list[tuple[list[str], list[str]]]:
    lines = (Path(__file__).parent.parent / "COVERAGE.md").read_text().splitlines()
    cells = [line.split("|")[1:-1] for line in lines if re.match(r"\| [TRGKN]\d+[a-d]? \|", line)]
    return [(re.findall("`(.+?)`", keys), re.findall("`(.+?)`", names)) for _, keys, names in cells]


def test_every_analysis_is_listed_once():
    keys = [key for found, _ in listed() for key in found]
    assert sorted(keys) == sorted(queries())


def test_functions_exist():
    names = {name for _, found in listed() for name in found}
    missing = [n for n in names if not hasattr(MODULES[n.split(".")[0]], n.split(".")[1])]
    assert not missing
