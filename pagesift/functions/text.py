"""Text helpers with the blank and placeholder rules of the directory pages.

The helpers of this package take and return SQL expression text; ``F.expr`` turns the result
into a column. A profile page needs some thousand operations: as text they are one call from
Python to the session, as Column objects they take seconds to put together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pagesift import fixed_values as fv


def quoted(value: str) -> str:
    """SQL literal; everything outside printable ASCII is written as an escape."""
    plain = value.replace("\\", "\\\\").replace("'", "\\'")
    return "'" + "".join(c if " " <= c <= "~" else f"\\u{ord(c):04x}" for c in plain) + "'"


def strip(text: str) -> str:
    """Strip every Unicode blank from both ends (SQL ``trim`` removes plain spaces only)."""
    return f"btrim({text}, {quoted(fv.BLANKS)})"


def known(value: str, placeholders: Sequence[str] = tuple(fv.GENERAL_PLACEHOLDERS)) -> str:
    """NULL where the value is one of the signs that stand for "nothing here"."""
    signs = ", ".join(quoted(p) for p in placeholders)
    return f"get(filter(array({value}), v -> v NOT IN ({signs})), 0)"


def none_if(value: str, sign: str) -> str:
    """``nullif`` that computes the value once, also where it stands inside a lambda."""
    return f"get(filter(array({value}), v -> v <> {quoted(sign)}), 0)"


def none_if_empty(value: str) -> str:
    return none_if(value, "")


def captured(text: str, pattern: str, group: int = 1) -> str:
    """Group of the first match, NULL without a match."""
    return none_if_empty(f"regexp_extract({text}, {quoted(pattern)}, {group})")


def id_from_text(text: str) -> str:
    """Identifier that follows the NPSN marker and a colon."""
    return captured(text, fv.NPSN_PATTERN)


def id_by_removal(text: str) -> str:
    """Identifier left over when the marker and every colon are taken out of the string."""
    return none_if_empty(strip(f"replace(replace({text}, 'NPSN', ''), ':', '')"))


def has_p_prefix(value: str) -> str:
    return f"lower(left({value}, 1)) = 'p'"


def document_url(profile_url: str, document_base: str) -> str:
    """Address of the licence document, built from the identifier inside a profile URL."""
    return f"concat({quoted(document_base)}, {captured(profile_url, fv.PROFILE_ID_PATTERN)}, '.pdf')"


def observed_profile_url(observed: str, list_url: str) -> str:
    """The URL seen after opening a card counts only if it changed and is a profile."""
    return f"CASE WHEN contains({observed}, 'profil-sekolah') AND NOT ({observed} <=> {list_url}) THEN {observed} END"


def built_profile_url(npsn: str, base_url: str) -> str:
    return f"concat({quoted(base_url + '/profil-sekolah/')}, {npsn})"
