"""IP text to number."""

from __future__ import annotations

_BYTES = 8
_NUMBERS = "^[+-]?[0-9]+([. ][+-]?[0-9]+)*$"


def ip_parts(ip: str) -> str:
    """The dot- or space-separated parts of an address, without empty ones at the end."""
    return f"split(trim(trailing '. ' from {ip}), '[. ]')"


def ip_number(parts: str, ip: str, strict: bool = False) -> str:
    """Fold the parts of an address, eight bits at a time. Takes and gives SQL text.

    Parts are not range checked and any count of them is folded, so `-1` gives -1 and two
    addresses in one field give one large number, as in existing tables. Only the last
    eight parts can reach a 64-bit result; older ones are shifted out. That makes the fold
    a fixed expression which stays in generated code, unlike a higher-order `aggregate`.
    Unreadable text gives NULL, or fails when `strict`.
    """
    folded = " | ".join(
        f"case when size({parts}) > {i} then "
        f"shiftleft(try_cast(get({parts}, size({parts}) - {i + 1}) as bigint), {8 * i}) else 0L end"
        for i in range(_BYTES))
    number = f"case when size({parts}) <= {_BYTES} or rlike({ip}, '{_NUMBERS}') then {folded} end"
    if not strict:
        return number
    return f"coalesce({number}, raise_error(concat('unreadable ip: ', coalesce({ip}, 'NULL'))))"
