"""SQL for DuckDB that says the same as the column functions; used by the oracles only."""

from __future__ import annotations

from ..functions.text import ACCENTED, DOUBLED, PLAIN
from ..functions.values import BAD_TOPIC

SPACE = "[\\s\\x{00A0}]+"
BAD = ", ".join(f"'{x}'" for x in BAD_TOPIC)


def squish(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}', ' ', 'g'))"


def clean_na(x: str) -> str:
    return f"nullif({squish(x)}, 'NA')"


def clean_html(x: str) -> str:
    bare = f"regexp_replace(coalesce({x}, ''), '<[^>]+>', ' ', 'g')"
    for entity, sign in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        bare = f"replace({bare}, '{entity}', '{sign}')"
    return f"nullif({squish(bare)}, '')"


def to_ascii(x: str) -> str:
    plain = f"translate(regexp_replace(lower({x}), '\\p{{Mn}}+', '', 'g'), '{ACCENTED}', '{PLAIN}')"
    for letter, two in DOUBLED.items():
        plain = f"replace({plain}, '{letter}', '{two}')"
    return plain


def alphanumeric(x: str) -> str:
    return f"trim(regexp_replace({to_ascii(x)}, '[^a-z0-9]+', ' ', 'g'))"


def bibliographic(x: str) -> str:
    return f"coalesce({alphanumeric(x)}, '')"


def title_key(x: str) -> str:
    bare = to_ascii(f"coalesce({x}, '')")
    return f"trim(regexp_replace(regexp_replace({bare}, '&[a-z]+;', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


def doi_body(x: str) -> str:
    body = f"regexp_replace(lower({clean_na(x)}), '^https?://(?:dx\\.)?doi\\.org/', '')"
    return f"trim(regexp_replace({body}, '^doi:\\s*', ''))"


def doi_key(x: str) -> str:
    return f"nullif({doi_body(x)}, '')"


def valid_doi(x: str) -> str:
    return f"CASE WHEN regexp_matches({doi_body(x)}, '^10\\.\\d{{4,9}}/\\S+$') THEN {doi_body(x)} END"


def first_author(x: str) -> str:
    return bibliographic(f"regexp_split_to_array(coalesce({x}, ''), '\\s*[|;]\\s*')[1]")


def pages(x: str) -> str:
    return f"regexp_replace(translate(regexp_replace(lower(coalesce({x}, '')), '{SPACE}', '', 'g'), '–—−', '---'), 'p$', '')"


def year(x: str) -> str:
    return f"try_cast(nullif(regexp_extract(cast({x} AS VARCHAR), '((?:18|19|20)\\d{{2}})', 1), '') AS INTEGER)"


def label(x: str) -> str:
    return f"CASE WHEN lower({squish(x)}) NOT IN ({BAD}) THEN {squish(x)} END"


def dedup_key(*parts: str) -> str:
    test = " AND ".join(f"coalesce({p} <> '', false)" for p in parts)
    return f"CASE WHEN {test} THEN {' || chr(124) || chr(124) || '.join(parts)} END"


def notice(x: str) -> str:
    def begins(words: str) -> str:
        return f"regexp_matches({x}, '(?i)^\\s*(?:{words})\\s*[:.—–-]')"

    return (
        f"CASE WHEN {begins('(?:retraction|retracted)(?:\\s+notice)?')} THEN 'retraction_notice' "
        f"WHEN {begins('withdrawal|withdrawn')} THEN 'withdrawal_notice' "
        f"WHEN {begins('correction|corrigendum|erratum')} THEN 'correction_notice' END"
    )
