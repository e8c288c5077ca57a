"""Independent row-wise models (tests only): plain-Python loops over one
workbook at a time, written from the layout rules, for comparison with the
Spark plans on random workbooks."""

from __future__ import annotations

import math
import random

LOCATION = "location"
MONTH = "january 2018"


def _jtrim(s: str) -> str:
    i, j = 0, len(s)
    while i < j and ord(s[i]) <= 32:
        i += 1
    while j > i and ord(s[j - 1]) <= 32:
        j -= 1
    return s[i:j]


def _text(cells, r, c):
    v = cells.get((r, c))
    if v is None:
        return ""
    if isinstance(v, str):
        return v
    if isinstance(v, float) and v == int(v):
        return str(int(v))
    return str(v)


def _last_match(cells, label):
    hit = None
    for (r, c) in sorted(cells):
        v = cells[(r, c)]
        if isinstance(v, str) and _jtrim(v).lower() == label:
            hit = (r, c)
    return hit


def inspection_model(book: list[tuple[str, dict]], compat_quarters=False, compat_regions=False,
                     fixed_start=49):
    """Rows (sheet_idx, Location, Description, freq, platform, last, q1..q4)."""
    out = []
    carried: dict[int, tuple[int, int]] = {}
    for sidx, (_, sheet) in enumerate(book):
        cells, merges = sheet["cells"], sheet.get("merges", [])
        loc = _last_match(cells, LOCATION)
        col = loc[1] if loc else -1
        own = [(m[0], m[1]) for m in merges if m[2] == col]
        if compat_regions:
            for i, rg in enumerate(own):
                carried[i] = rg
            regions = [carried[i] for i in sorted(carried)]
        else:
            regions = own
        if loc is None:
            continue
        mon = _last_match(cells, MONTH)
        if mon is None:
            continue
        start = mon[1]
        if compat_quarters:
            b = [fixed_start + 12 * k for k in range(5)]
            bounds = [(start, b[1] - 1), (b[1], b[2] - 1), (b[2], b[3] - 1), (b[3], b[4] - 1)]
        else:
            bounds = [(start + 12 * k, start + 12 * k + 11) for k in range(4)]
        for (first, last) in regions:
            name = _text(cells, first, col)
            plat = _text(cells, first, col + 3)
            descs: dict[str, tuple] = {}
            for x in range(first, last + 1, 2):
                qs = []
                for lo, hi in bounds:
                    p = sum(1 for c in range(lo, hi + 1) if isinstance(cells.get((x, c)), float))
                    d = sum(1 for c in range(lo, hi + 1) if isinstance(cells.get((x + 1, c)), float))
                    qs.append(math.nan if p == 0 and d == 0 else 0.0 if p == 0 else d / p * 100)
                descs[_text(cells, x, col + 1)] = (_text(cells, x, col + 2),
                                                   _text(cells, x, col + 4), *qs)
            for desc, v in descs.items():
                if name != "Location":
                    out.append((sidx, name, desc, v[0], plat, v[1], *v[2:]))
    return out


def random_schedule_book(rng: random.Random, n_sheets: int = 3) -> list[tuple[str, dict]]:
    """Sheets with a Location header, location blocks merged in its column,
    repeated descriptions and numeric/text/absent week cells."""
    book = []
    for s in range(n_sheets):
        cells, merges = {}, []
        lc = rng.choice([0, 1, 2])
        start = rng.choice([47, 49, 51])
        cells[(1, lc)] = "Location"
        cells[(1, start)] = "January 2018"
        merges.append((1, 2, lc, lc))
        if rng.random() < 0.5:
            merges.append((0, 0, lc + 5, lc + 9))  # other column: ignored
        row = 3
        for b in range(rng.randint(0, 4)):
            h = rng.randint(1, 6)
            cells[(row, lc)] = f"LOC{rng.randint(0, 3)}"
            cells[(row, lc + 3)] = f"PF{b}"
            for x in range(row, row + h + 1):
                if rng.random() < 0.8:
                    cells[(x, lc + 1)] = rng.choice(["pump", "valve", "pipe"])
                cells[(x, lc + 2)] = str(rng.randint(1, 9))
                cells[(x, lc + 4)] = f"2018-0{rng.randint(1, 9)}-01"
                for c in range(start - 3, start + 50):
                    u = rng.random()
                    if u < 0.15:
                        cells[(x, c)] = float(rng.randint(1, 3))
                    elif u < 0.25:
                        cells[(x, c)] = "-"
            merges.append((row, row + h - 1, lc, lc))
            row += h + rng.randint(0, 2)
        book.append((f"S{s}", {"cells": cells, "merges": merges}))
    return book
