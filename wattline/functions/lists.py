"""Expressions over list cells: readings (array<double>) and codes (array<string>).

They are SQL text, to be used with ``F.expr`` or ``selectExpr``: a nest of lambdas is then one
call to the JVM instead of hundreds. Arguments are column names or other such texts.
"""

from __future__ import annotations

from collections.abc import Callable

from wattline import constants as C

# An item of a list text: quoted, with either quote, or bare. The quote is written as \x27.
_ITEM = r"\x27(?:[^\x27\\]|\\.)*+\x27|\"(?:[^\"\\]|\\.)*+\"|[^,\[\]\s\x27\"]++"
# Bare words of list texts and how JSON writes them.
_WORDS = {"None": "null", "nan": "null", "inf": "Infinity", "-inf": "-Infinity"}


def let(value: str, name: str, body: str) -> str:
    """``body``, in which ``name`` stands for ``value``; the value is computed once per row.

    Inside a lambda a plain sub-expression would be computed again for every element.
    """
    return f"transform(array({value}), {name} -> {body})[0]"


def once(value: str, name: str, body: Callable[[str], str]) -> str:
    """``body`` of ``value``; a plain column needs no ``let``."""
    return body(value) if value.isidentifier() else let(value, name, body(name))


def fill_zero(readings: str) -> str:
    return f"transform({readings}, x -> coalesce(x, 0D))"


def nan_to_null(readings: str) -> str:
    return f"transform({readings}, x -> if(isnan(x), null, x))"


def series_length(items: str) -> str:
    return f"size({items})"


def count_missing(items: str) -> str:
    return f"size(filter({items}, x -> x IS NULL))"


def missing_ratio(items: str) -> str:
    """Share of missing items; NULL for an empty list."""
    return once(items, "whole", lambda a: f"try_divide({count_missing(a)}, size({a}))")


def tail(items: str, n: int = C.SERIES_TAIL) -> str:
    """The last ``n`` items, or all of a shorter list."""
    return once(items, "whole", lambda a: f"slice({a}, greatest(1, size({a}) - {n - 1}), {n})")


def last_item(items: str) -> str:
    return f"try_element_at({items}, -1)"


def tail_desc(items: str, n: int) -> list[str]:
    """The last ``n`` numbers, newest first, 0 where the list is too short."""
    return [f"coalesce(try_element_at({items}, -{i}), 0D)" for i in range(1, n + 1)]


def _parse(text: str, kind: str) -> str:
    words = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _WORDS.items())
    items = f"transform(regexp_extract_all({text}, r'{_ITEM}', 0), x -> CASE x {words} ELSE x END)"
    listed = f"{text} RLIKE r'^\\s*\\[[\\s\\S]*\\]\\s*$'"
    json = f"if({listed}, concat('[', array_join({items}, ','), ']'), {text})"
    return f"from_json({json}, 'array<{kind}>', map('mode', 'FAILFAST'))"


def parse_reading_list(text: str) -> str:
    """``[None, 1.0, nan]`` -> array<double>. Text that is no list fails the job."""
    return nan_to_null(_parse(text, "double"))


def parse_code_list(text: str) -> str:
    """``['NR', None]`` -> array<string>. A quoted 'None' stays a code."""
    return _parse(text, "string")


def _shares(readings: str, months: int) -> str:
    # The cast drops the fraction toward zero.
    return f"transform({readings}, x -> double(bigint(x / {months})))"


def bimonthly_split(readings: str) -> str:
    """Halve each reading; a gap takes half of the reading after it, or leaves the list."""
    filled = "transform(halves, (x, i) -> coalesce(x, get(halves, i + 1)))"
    return let(_shares(readings, 2), "halves", f"filter({filled}, x -> x IS NOT NULL)")


def trimonthly_split(readings: str) -> str:
    """Spread a third of each reading over its month and the two before; a later reading wins.

    Missing items after the last reading leave the list.
    """
    spread = "transform(thirds, (x, i) -> coalesce(get(thirds, i + 2), get(thirds, i + 1), x))"
    last = "coalesce(array_max(transform(thirds, (x, i) -> if(x IS NULL, null, i + 1))), 0)"
    return let(_shares(readings, 3), "thirds", f"slice({spread}, 1, {last})")


def cycle_dispatch(cno: str, readings: str) -> str:
    """Split the readings by the billing cycle that the consumer number's prefix tells."""
    return f"""CASE WHEN startswith({cno}, '{C.BIMONTHLY_PREFIX}') THEN {bimonthly_split(readings)}
        WHEN startswith({cno}, '{C.TRIMONTHLY_PREFIX}') THEN {trimonthly_split(readings)}
        ELSE {readings} END"""
