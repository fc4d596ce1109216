"""Column functions for cleaning, normalising and keying bibliographic text.

All of them are built-in expressions, so they stay inside generated code and reach the scan as
projections. NULL handling is part of each definition and given in its docstring.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented letters and the plain ones they become, then letters that become two.
ACCENTED = "àáâãäåāăąçćčďđèéêëēĕęěìíîïīĭįıłñńňòóôõöøōőŕřśşšťţùúûüūůűųýÿźżž"
PLAIN = "aaaaaaaaacccddeeeeeeeeiiiiiiiilnnnoooooooorrsssttuuuuuuuuyyzzz"
DOUBLED = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d"}
#: White space including the no-break space.
SPACE = r"[\s\x{00A0}]+"


def squish(text: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACE, " "))


def clean_na(text: Column) -> Column:
    """Squished; the text "NA" is NULL."""
    return F.nullif(squish(text), F.lit("NA"))


def clean_html(text: Column) -> Column:
    """Tags become a space, then &nbsp; &amp; &lt; &gt; in this order; squished; empty is NULL."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", " ")
    for entity, sign in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        bare = F.replace(bare, F.lit(entity), F.lit(sign))
    return F.nullif(squish(bare), F.lit(""))


def to_ascii(text: Column) -> Column:
    """Lower case with accents taken off, those written as marks of their own too."""
    plain = F.translate(F.regexp_replace(F.lower(text), r"\p{Mn}+", ""), ACCENTED, PLAIN)
    for letter, two in DOUBLED.items():
        plain = F.replace(plain, F.lit(letter), F.lit(two))
    return plain


def alphanumeric(text: Column) -> Column:
    """ASCII letters and digits, other runs one space; NULL stays NULL."""
    return F.trim(F.regexp_replace(to_ascii(text), "[^a-z0-9]+", " "))


def bibliographic_text(text: Column) -> Column:
    """As ``alphanumeric``, NULL is empty."""
    return F.coalesce(alphanumeric(text), F.lit(""))


def screening_title(text: Column) -> Column:
    """As ``bibliographic_text`` with named entities taken out."""
    bare = F.regexp_replace(to_ascii(F.coalesce(text, F.lit(""))), "&[a-z]+;", " ")
    return F.trim(F.regexp_replace(bare, "[^a-z0-9]+", " "))


def _doi_body(text: Column) -> Column:
    body = F.regexp_replace(F.lower(clean_na(text)), r"^https?://(?:dx\.)?doi\.org/", "")
    return F.trim(F.regexp_replace(body, r"^doi:\s*", ""))


def screening_doi(text: Column) -> Column:
    """Lower case without resolver and "doi:"; empty is NULL; no check of its form."""
    return F.nullif(_doi_body(text), F.lit(""))


def valid_doi(text: Column) -> Column:
    """As ``screening_doi``; NULL unless 10.<4 to 9 digits>/<no spaces>."""
    body = _doi_body(text)
    return F.when(body.rlike(r"^10\.\d{4,9}/\S+$"), body)


def lookup_doi(text: Column) -> Column:
    """As ``screening_doi``; NULL is empty."""
    return F.coalesce(screening_doi(text), F.lit(""))


def cited_doi(text: Column) -> Column:
    """Letters as they are, without the resolver's address."""
    return F.trim(F.regexp_replace(text, r"(?i)^https?://(?:dx\.)?doi\.org/", ""))


def first_year(text: Column) -> Column:
    """The first year from 1800 to 2099 in the text."""
    return F.nullif(F.regexp_extract(text.cast("string"), r"((?:18|19|20)\d{2})", 1), F.lit("")).cast("int")


def page_key(text: Column) -> Column:
    """Lower case without white space, any dash a hyphen, without one trailing "p"; NULL is empty."""
    bare = F.translate(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), SPACE, ""), "–—−", "---")
    return F.regexp_replace(bare, "p$", "")


def first_author_key(text: Column) -> Column:
    """Text before the first | or ;, as ``bibliographic_text``."""
    return bibliographic_text(F.get(F.split(F.coalesce(text, F.lit("")), r"\s*[|;]\s*", 2), F.lit(0)))


def screening_text(title: Column, abstract: Column) -> Column:
    """Title twice and abstract once, marked."""
    t, a = F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit(""))
    return squish(F.concat(F.lit("TITLE_TITLE "), t, F.lit(" TITLE_TITLE "), t, F.lit(" ABSTRACT "), a))


def token_key(title_key: Column) -> Column:
    """The first eight words, distinct and sorted."""
    return F.array_join(F.array_sort(F.array_distinct(F.slice(F.split(title_key, " "), 1, 8))), " ")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+"))


def dedup_key(*parts: Column) -> Column:
    """Parts joined by ||; NULL if any is NULL or empty."""
    whole = F.lit(True)
    for p in parts:
        whole = whole & F.coalesce(p != "", F.lit(False))
    return F.when(whole, F.concat_ws("||", *parts))


def notice_type(title: Column) -> Column:
    """retraction_notice, withdrawal_notice, correction_notice or NULL by the title's beginning."""

    def begins(words: str) -> Column:
        return title.rlike(rf"(?i)^\s*(?:{words})\s*[:.—–-]")

    return (
        F.when(begins(r"(?:retraction|retracted)(?:\s+notice)?"), "retraction_notice")
        .when(begins("withdrawal|withdrawn"), "withdrawal_notice")
        .when(begins("correction|corrigendum|erratum"), "correction_notice")
    )


def lens_url(record: Column) -> Column:
    """An http(s) address as it is; a "lens-" id its address; else empty."""
    text = F.trim(F.coalesce(record, F.lit("")))
    return F.when(text.rlike("^https?://"), text).when(
        text.rlike("^lens-"), F.concat(F.lit("https://lens.org/"), F.regexp_replace(text, "^lens-", ""))
    ).otherwise("")


def scholar_query(title: Column) -> Column:
    """Letters, digits and spaces of the title, spaces as "+"."""
    return F.regexp_replace(F.trim(F.regexp_replace(title, r"[^\p{L}\p{N}\s]", "")), r"\s+", "+")


def short_abstract(text: Column, n: int = 220) -> Column:
    """Cut after n characters at a word's end, with an ellipsis."""
    cut = F.regexp_replace(F.substring(text, 1, n + 1), r"\s+\S*$", "")
    return F.when(F.length(text) <= n, text).otherwise(F.concat(cut, F.lit("…")))


def author_line(authors: Column) -> Column:
    """One or two authors joined by "and", of more the first "et al."."""
    names = F.filter(F.transform(F.split(F.coalesce(authors, F.lit("")), r"[;|]|\s+and\s+"), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(names) <= 2, F.array_join(names, " and ")).otherwise(F.concat(F.get(names, F.lit(0)), F.lit(" et al.")))


def publication_line(journal: Column, volume: Column, pages: Column) -> Column:
    """Journal · volume · pp. pages, leaving out blanks."""
    blank = F.lit("")
    return F.concat_ws(" · ", F.nullif(F.trim(journal), blank), F.nullif(F.trim(volume), blank), F.concat(F.lit("pp. "), F.nullif(F.trim(pages), blank)))


def number(text: Column) -> Column:
    """Whole part of a number, NULL if the text is none."""
    return text.try_cast("double").try_cast("int")


def shorten_terms(text: Column, n: int = 10) -> Column:
    """Distinct terms (case apart, first writing kept) of a ";" list, the first n."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), r";\s*"), lambda x: F.trim(x) != "")
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.array_append(acc, x)),
    )
    return F.array_join(F.slice(kept, 1, n), "; ")
