"""Labels, serials and keys derived from single rows (SQL text)."""

from __future__ import annotations

from collections.abc import Sequence

from wattline import constants as C


def label_from_flags(xchg: str, adv: str) -> str:
    """1 when the meter was exchanged or the exchange was advised; a missing flag counts as no."""
    return f"int({xchg} <=> 'Y' OR {adv} <=> 'Y')"


def label_from_current_meter(is_current: str) -> str:
    """0 for the meter in use, 1 for one taken down, NULL when unknown."""
    return f"int(NOT {is_current})"


def relabel_from_remark(label: str, remark: str) -> str:
    """The field inspector's finding overrides the label."""
    return f"""CASE WHEN {label} = 1 AND {remark} = '{C.REMARK_OK}' THEN 0
        WHEN {label} = 0 AND {remark} = '{C.REMARK_DEFECTIVE}' THEN 1 ELSE {label} END"""


def is_other_meter(remark: str) -> str:
    """The inspector saw another meter; a missing remark is not such a finding."""
    return f"{remark} <=> '{C.REMARK_OTHER_METER_OK}'"


def composite_key(mfg: str, amp: str, vlt: str) -> str:
    """``MFG|AMP|VLT`` for display; joins use the three columns. NULL if one is missing."""
    return f"{mfg} || '|' || {amp} || '|' || {vlt}"


def serial_number(mno: str) -> str:
    """The meter number as an integer, NULL when it is not one."""
    return f"try_cast({mno} AS bigint)"


def is_supported_model(mcd: str, supported: Sequence[int] = C.SUPPORTED_MCD) -> str:
    return f"coalesce({mcd} IN ({', '.join(map(str, supported))}), false)"
