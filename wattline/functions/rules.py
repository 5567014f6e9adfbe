"""Rules over one consumer's meter type, readings and exception codes (SQL conditions).

A rule is a condition over the columns ELC, adv_ut_list, ent_cd_list and MNO. One that is NULL
does not fire. Extend a rule table with conditions of your own to add rules.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from wattline import constants as C
from wattline.functions.labels import serial_number
from wattline.functions.lists import last_item, once, tail
from wattline.functions.stats import total

READINGS, CODES = "adv_ut_list", "ent_cd_list"
ELECTROMECHANICAL, ELECTRONIC = "ELC <=> 'N'", "ELC <=> 'Y'"


def fires(condition: str) -> str:
    """1 if the condition holds, 0 if not or unknown."""
    return f"if({condition}, 1, 0)"


def code_in_last(codes: str, code: str, n: int = 3) -> str:
    return f"exists({tail(codes, n)}, x -> x <=> '{code}')"


def consecutive_code(codes: str, code: str = "NR") -> str:
    """The code in two neighbouring months."""

    def body(a: str) -> str:
        pairs = f"transform({a}, (x, i) -> x <=> '{code}' AND get({a}, i + 1) <=> '{code}')"
        return f"exists({pairs}, hit -> hit)"

    return once(codes, "codes", body)


def prior_mean(readings: str, n: int = 6) -> str:
    """Mean of the ``n`` readings before the last; NULL for fewer or if one is missing."""

    def body(a: str) -> str:
        return f"if(size({a}) > {n}, {total(f'slice({a}, size({a}) - {n}, {n})')} / {n}, null)"

    return once(readings, "series", body)


def spike(readings: str, factor: int, floor: int = 50) -> str:
    """The last reading exceeds ``factor`` times the mean before it, and that mean the floor."""
    average = prior_mean(readings)
    return f"{average} > {floor} AND {last_item(readings)} > {factor} * {average}"


RULES: dict[str, str] = {
    "t_1_c_1": f"{ELECTROMECHANICAL} AND {code_in_last(CODES, 'SP')}",
    "t_1_c_2": f"{ELECTROMECHANICAL} AND {last_item(READINGS)} < 10",
    "t_1_c_3": f"{ELECTROMECHANICAL} AND {code_in_last(CODES, 'LW')}",
    "t_2_c_1": f"{ELECTRONIC} AND {spike(READINGS, 4)}",
    "t_2_c_2": f"{ELECTRONIC} AND {spike(READINGS, 8)}",
    "t_2_c_3": f"{ELECTRONIC} AND {code_in_last(CODES, 'NR')}",
    "t_2_c_4": f"{ELECTRONIC} AND {serial_number('MNO')} BETWEEN {C.SUSPECT_SERIALS[0]} AND {C.SUSPECT_SERIALS[1]}",
    "t_a_c_1": f"{last_item(CODES)} IN ({', '.join(map(repr, C.BAD_LAST_CODES))})",
    "consecutive_NR": consecutive_code(CODES),
}
# The live rules expect zero-filled readings; the scored ones take them as they are.
LIVE_RULES = {name: rule for name, rule in RULES.items() if name != "t_2_c_4"}
SCORED_RULES = {name: RULES[name] for name in C.SCORE_WEIGHTS}


def apply_rules(df: DataFrame, rules: Mapping[str, str] | None = None) -> DataFrame:
    """Add a 0/1 column per rule."""
    rules = LIVE_RULES if rules is None else rules
    return df.selectExpr("*", *(f"{fires(rule)} AS {name}" for name, rule in rules.items()))


def weighted_sum(weights: Mapping[str, float], rules: Mapping[str, str] | None = None) -> str:
    """Sum of the weights of the rules that fire, from their columns or from ``rules``."""
    if rules is None:
        return " + ".join(f"{name} * {weight}D" for name, weight in weights.items())
    return " + ".join(f"{fires(rules[name])} * {weight}" for name, weight in weights.items())


def electronic_weight() -> str:
    return weighted_sum(C.ELECTRONIC_WEIGHTS)


def electromechanical_weight() -> str:
    return weighted_sum(C.ELECTROMECHANICAL_WEIGHTS)


def common_weight() -> str:
    return weighted_sum(C.COMMON_WEIGHTS)


def computed_score(rules: Mapping[str, str] | None = None) -> str:
    """Integer score of the rules that fire on unfilled readings."""
    return weighted_sum(C.SCORE_WEIGHTS, rules or SCORED_RULES)


def score_bin(score: str) -> str:
    """Name of the left-closed bin; a score of exactly 1 has none."""
    bins = " ".join(f"WHEN {score} < {edge}D THEN '{name}'" for edge, name in C.SCORE_BINS)
    return f"CASE WHEN {score} < 0 THEN null {bins} END"
