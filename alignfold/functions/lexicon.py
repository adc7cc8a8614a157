"""Reward lexicons (D15): (category, term) rows loaded from a data file, never hard-coded in rules."""

from __future__ import annotations

import csv
import os
from dataclasses import dataclass, field


DATA_DIR = os.path.join(os.path.dirname(os.path.dirname(__file__)), "data")
ENTITY_CATEGORIES = ("drug", "symptom", "diagnosis", "care")


@dataclass(frozen=True)
class Lexicon:
    terms: dict = field(default_factory=dict)  # category -> tuple of terms, file order

    def get(self, category: str) -> tuple:
        return tuple(self.terms.get(category, ()))

    def rows(self):
        return [(c, t) for c, ts in self.terms.items() for t in ts]


def load_lexicon(name_or_path: str = "clinical") -> Lexicon:
    path = name_or_path
    if not os.path.exists(path):
        path = os.path.join(DATA_DIR, f"lexicon_{name_or_path}.csv")
    terms: dict = {}
    with open(path, encoding="utf-8") as f:
        lines = [ln for ln in f if not ln.startswith("#")]
    for row in csv.DictReader(lines):
        terms.setdefault(row["category"], [])
        if row["term"] not in terms[row["category"]]:
            terms[row["category"]].append(row["term"])
    return Lexicon({k: tuple(v) for k, v in terms.items()})

