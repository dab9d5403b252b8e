"""Tables whose rows only a scan from token to token can tell apart.

A ``ScanRule`` reads the compacted text of one artifact from left to right and remembers
what accepted rows hand on. It runs in Arrow batches on the texts that pass its gates; what
it keeps in memory is one text and its rows. Looking past the end of the tokens finds "".
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from noticeloom import fixed

MONEY = re.compile(fixed.MONEY)
NUMBER = re.compile(r"[0-9]+")
WHOLE = re.compile(r"[0-9]{1,18}")
AREA = re.compile(r"[0-9]+(?:\.[0-9]+)?")

Found = Iterator[tuple[str, dict[str, str]]]


@dataclass(frozen=True)
class ScanRule:
    """``scan`` turns a text into (raw text, content) rows, in reading order."""

    table: str
    gates: tuple[str, ...]
    scan: Callable[[str], Found]


class Tokens:
    """Tokens as written and without outer punctuation."""

    def __init__(self, text: str):
        self.raw = text.split()
        self.clean = [t.strip(fixed.CELL_TOKEN_TRIM) for t in self.raw]

    def __len__(self) -> int:
        return len(self.raw)

    def at(self, i: int) -> str:
        return self.clean[i] if 0 <= i < len(self.clean) else ""

    def count(self, i: int) -> bool:
        return self.at(i) == "-" or bool(NUMBER.fullmatch(self.at(i)))

    def money(self, i: int) -> bool:
        return bool(MONEY.search(self.at(i)))

    def area(self, i: int) -> bool:
        return bool(AREA.fullmatch(self.at(i))) and ("." in self.at(i) or self.at(i) in fixed.JEONSE_AREAS)

    def text(self, begin: int, end: int) -> str:
        return " ".join(self.raw[begin:end])


def label(*parts: str) -> str:
    return " ".join(p for p in parts if p)


@dataclass(frozen=True)
class PriceTable:
    """Rows of area, category, count, three amounts and, after other figures, the heating kind.

    The district holds until the next one. A row without a name or without an area takes
    those of the last accepted row; one that has no district or no name then is no row: it
    hands nothing on, and its tokens stay where a name may begin.
    """

    source: str
    money_unit: str
    districts: frozenset[str] = frozenset(fixed.JEONSE_DISTRICTS)
    categories: frozenset[str] = frozenset(fixed.JEONSE_CATEGORIES)
    headers: frozenset[str] = frozenset(fixed.JEONSE_HEADER_WORDS)
    #: How far after the count the first amount may stand, and after the last one the heating kind.
    amounts_within: int = 4
    heating_within: int = 8

    def heating(self, t: Tokens, start: int) -> tuple[str, int] | None:
        """Heating kind in one or two tokens, and where it ends."""
        for i in range(start, start + self.heating_within + 1):
            for width in (1, 2):
                word = "".join(t.at(i + k) for k in range(width))
                if word in _HEATING and t.at(i) in (word, word.removesuffix(fixed.HEATING_WORD)):
                    return word, i + width
        return None

    def row(self, t: Tokens, i: int, held: dict[str, str], opened: int) -> tuple[dict[str, str], int] | None:
        own_area = t.area(i)
        if not own_area and not (held["area"] and t.at(i) in self.categories):
            return None
        j = i + own_area
        category = t.at(j) if t.at(j) in self.categories else ""
        j += bool(category)
        first = next((k for k in range(j + 1, j + 1 + self.amounts_within) if t.money(k)), None)
        if not t.count(j) or first is None or not (t.money(first + 1) and t.money(first + 2)):
            return None
        heating = self.heating(t, first + 3)
        words = [w for w in t.clean[opened:i] if w and w not in self.headers and w not in self.districts]
        name = " ".join(words) or held["name"]
        if not heating or not held["district"] or not name:
            return None
        area = t.at(i) if own_area else held["area"]
        content = {
            "source": self.source, "district": held["district"], "housing_name": name, "exclusive_area_m2": area, "application_category": category,
            "supply_count": t.at(j), "jeonse_deposit_text": t.at(first), "contract_deposit_text": t.at(first + 1), "balance_payment_text": t.at(first + 2),
            "money_unit": self.money_unit, "heating_method": heating[0], "reserved_count": t.at(first - 1) if first - j >= 3 and t.count(first - 1) else "",
            "application_unit_label": label(name, area, category)}
        return content, heating[1]

    def __call__(self, text: str) -> Found:
        t, i, opened = Tokens(text), 0, 0
        held = {"district": "", "name": "", "area": ""}
        while i < len(t):
            word = t.clean[i]
            if word in self.districts:
                held["district"], opened = word, i + 1
            elif (word[:1].isdigit() or word in self.categories) and (found := self.row(t, i, held, opened)):
                content, end = found
                yield t.text(i, end), content
                held.update(name=content["housing_name"], area=content["exclusive_area_m2"])
                i = opened = end
                continue
            i += 1


_HEATING = frozenset(kind + fixed.HEATING_WORD for kind in fixed.HEATING_KINDS)


def section(text: str, start: str, end: str) -> str:
    """From the first ``start`` up to the next ``end``; without an end, the rest."""
    begin = text.find(start)
    stop = text.find(end, begin + 1)
    return "" if begin < 0 else text[begin:stop if stop > 0 else len(text)]


def won(amount: int) -> str:
    return f"{amount:,}원"


def amount(token: str) -> int | None:
    digits = token.replace(",", "")
    return int(digits) if WHOLE.fullmatch(digits) else None


@dataclass(frozen=True)
class TypeGroups:
    """Unit rows (unit kind, category, count, two amounts, area) summed per supply type.

    A pair of amounts holds until the next pair or the next type, whether its row is
    accepted or not; a row without amounts or area is no row. Types come in the order of
    their first row, with the amounts of that row and the last category.
    """

    name: str
    supply_method: str
    source: str
    start: str = fixed.TYPE_SECTION_START
    end: str = fixed.TYPE_SECTION_END
    head: re.Pattern = re.compile(fixed.TYPE_HEAD)
    unit: re.Pattern = re.compile(fixed.TYPE_UNIT)
    category: str = fixed.TYPE_CATEGORY
    suffix: str = fixed.TYPE_SUFFIX

    def units(self, t: Tokens) -> Iterator[dict]:
        i, kind, price = 0, "", (0, 0)
        while i < len(t):
            if self.head.fullmatch(t.at(i)):
                kind, price = t.at(i), (0, 0)
            elif kind and self.unit.fullmatch(t.at(i)):
                j = i + 1
                category = self.category if j < len(t) and self.category in t.raw[j] else ""
                j += bool(category)
                if WHOLE.fullmatch(t.at(j)):
                    many, j = int(t.at(j)), j + 1
                    if t.money(j) and t.money(j + 1):
                        deposit, rent = amount(t.at(j)), amount(t.at(j + 1))
                        price = (price[0] if deposit is None else deposit * 1000, price[1] if rent is None else rent)
                        j += 2
                    if all(price) and t.area(j):
                        yield {"kind": kind, "unit": t.at(i), "category": category, "count": many, "deposit": price[0], "rent": price[1], "area": t.at(j)}
                        i = j
            i += 1

    def __call__(self, text: str) -> Found:
        groups: dict[str, list[dict]] = {}
        for unit in self.units(Tokens(section(text, self.start, self.end))):
            groups.setdefault(unit["kind"], []).append(unit)
        for kind, units in groups.items():
            many = sum(u["count"] for u in units)
            if not many:
                continue
            category = next((u["category"] for u in reversed(units) if u["category"]), "")
            shown = label(self.name, kind, category)
            rows = [{"unit_type": u["unit"], "supply_count": str(u["count"]), "exclusive_area_m2": u["area"], "deposit_text": won(u["deposit"]),
                     "monthly_rent_text": won(u["rent"])} for u in units]
            yield shown, {
                "source": self.source, "housing_name": self.name, "supply_method": self.supply_method, "supply_category": self.supply_method,
                "application_category": category, "application_unit_label": shown, "supply_count": str(many), "exclusive_area_m2": kind.removesuffix(self.suffix),
                "deposit_text": won(units[0]["deposit"]), "monthly_rent_text": won(units[0]["rent"]), "unit_rows": json.dumps(rows, ensure_ascii=False, separators=(",", ":"))}


TYPES = ScanRule("magok_challenge_house_supply", fixed.TYPE_GATES, TypeGroups(fixed.TYPE_NAME, fixed.TYPE_SUPPLY_METHOD, "hwp_text_magok_challenge_house_supply"))
PRICE_TABLE = ScanRule("long_term_jeonse", fixed.JEONSE_GATES, PriceTable("pdf_table_long_term_jeonse", fixed.JEONSE_MONEY_UNIT))
