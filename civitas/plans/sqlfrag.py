"""DuckDB SQL fragments mirroring the scalar functions, for oracle SQL."""

from __future__ import annotations

# Fixed values, written out apart from the code they check: white space of
# str.strip(), and decimal literals.
WS = ("[" + "".join(rf"\x{{{c:04X}}}" for c in [*range(0x09, 0x0E), 0x20, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680,
                                                  *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]) + "]")
NUMBER_PATTERN = r"^[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][-+]?[0-9]+)?$"


def zfill(x: str, n: int) -> str:
    return f"(CASE WHEN length({x}) < {n} THEN lpad({x}, {n}, '0') ELSE {x} END)"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def parse_number(x: str) -> str:
    cleaned = f"replace(regexp_replace(CAST({x} AS VARCHAR), '{WS}+', '', 'g'), ',', '.')"
    return coerce(cleaned)


def coerce(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, '{NUMBER_PATTERN}') THEN TRY_CAST({x} AS DOUBLE) END)"


def round_even(x: str, d: int = 2) -> str:
    s = 10 ** d
    return f"(round_even(({x}) * {s}.0, 0) / {s}.0)"


def min_count_sum(cols) -> str:
    total = " + ".join(f"coalesce({c}, 0)" for c in cols)
    return f"(CASE WHEN coalesce({', '.join(cols)}) IS NOT NULL THEN {total} END)"


def zero_sum(cols) -> str:
    return "(" + " + ".join(f"coalesce({c}, 0)" for c in cols) + ")"


def share(part: str, total: str) -> str:
    return f"(CASE WHEN ({total}) > 0 THEN ({part}) / ({total}) * 100 END)"


def remove_accents(x: str) -> str:
    return f"strip_accents({strip(x)})"


def normalize_place_name(x: str) -> str:
    up = f"upper(replace({x}, 'ß', 'SS'))"
    return strip(f"translate(strip_accents({up}), '-''', '  ')")
