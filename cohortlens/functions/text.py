"""Text functions as Column expressions."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT

# Legal forms dropped from the end of a company name.
LEGAL_SUFFIXES = "ab ag as bv co corp corporation gmbh inc incorporated limited llc ltd nv oy plc pty sa sas spa srl".split()
# Words that say how a job is worked, not where.
WORK_ARRANGEMENT = "a and anywhere distributed flexible hybrid in n na office on onsite or remote site".split()
# Tags that end a line and the steps from HTML to text.
_BLOCKS = "p|div|h[1-6]|ul|ol|tr|section|article"


@F.pandas_udf(T.StringType())
def _unescape_all(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def unescape_html(text: Column) -> Column:
    """Named and numeric character references of HTML resolved; only texts that hold one leave the JVM."""
    return F.when(text.contains("&"), _unescape_all(F.when(text.contains("&"), text))).otherwise(text)


def html_to_text(markup: Column, escaped: bool = False) -> Column:
    """Plain text of HTML, with a line per block and `- ` before list items. escaped: the markup itself is entity-encoded."""
    text = unescape_html(markup) if escaped else markup
    text = F.regexp_replace(text, r"(?i)<li\b[^>]*>", "\n- ")
    text = F.regexp_replace(text, rf"(?i)<br\s*/?>|</(?:{_BLOCKS})>", "\n")
    text = unescape_html(F.regexp_replace(text, r"<[^>]+>", ""))
    text = F.regexp_replace(text, "[ \\t\\r\\f\\u000B\\u00A0]+", " ")
    text = F.regexp_replace(text, r"(?mdU)^[^\S\n]+|[^\S\n]+$", "")
    text = F.regexp_replace(text, r"(?md)^-\n+", "- ")
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    return F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")


def normalize_company(name: Column) -> Column:
    """Lower case, words only, without legal forms at the end; the first word always stays."""
    words = F.trim(F.regexp_replace(F.lower(name), r"(?U)[^\w]+", " "))
    return F.regexp_replace(words, rf"( (?:{'|'.join(LEGAL_SUFFIXES)}))+$", "")


def normalize_title(title: Column) -> Column:
    """Lower-case letters and digits, with one space around every word, ends included."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(title), "[^a-z0-9]+", " ")), F.lit(" "))


def skill_slug(name: Column) -> Column:
    slug = F.regexp_replace(F.regexp_replace(F.lower(name), r"\+", "-plus"), "#", "-sharp")
    return F.regexp_replace(F.regexp_replace(slug, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def normalize_skill(name: Column) -> Column:
    """Letters and digits alone, without a final s if more than three characters."""
    compact = F.regexp_replace(F.lower(name), "[^a-z0-9]+", "")
    plural = compact.endswith("s") & (F.length(compact) > 3)
    return F.when(plural, F.substring(compact, F.lit(1), F.length(compact) - 1)).otherwise(compact)


def text_quality(source: Column, text: Column, config=DEFAULT) -> Column:
    short = F.length(F.coalesce(text, F.lit(""))) < config.full_text_min_chars
    return F.when(source.isin(*config.excerpt_only) | short, "excerpt").otherwise("full")


def content_hash(title: Column, text: Column) -> Column:
    return F.sha2(F.concat(title, F.lit("\n"), F.coalesce(text, F.lit(""))), 256)


def dedupe_key(company: Column, title: Column, country: Column, source: Column, source_id: Column) -> Column:
    """Equal for the same company, title and country; unknown companies never share a key."""
    empty = F.lit("")
    known = F.sha2(F.concat_ws("|", normalize_company(company), F.trim(normalize_title(title)), F.coalesce(country, empty)), 256)
    return F.when(F.coalesce(company, empty) == "", F.sha2(F.concat(source, F.lit(":"), source_id), 256)).otherwise(known)


def estimate_tokens(text: Column, config=DEFAULT) -> Column:
    return F.ceil(F.length(text) / config.chars_per_token)


def build_prompt(instructions: str, title: Column, company: Column, location: Column, text: Column, config=DEFAULT) -> Column:
    """Instructions, a header of what is known, the text's beginning."""

    def line(label: str, value: Column) -> Column:
        return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{label}: "), value))

    header = F.concat_ws("\n", F.concat(F.lit("Title: "), title), line("Company", company), line("Location", location))
    cut = F.substring(F.coalesce(text, F.lit("")), 1, config.max_posting_chars)
    return F.concat(F.lit(f"{instructions}\n\n--- JOB POSTING ---\n"), header, F.lit("\n\n"), cut)


def only_work_arrangement(location: Column) -> Column:
    """Whether a location names no place: all its words say how a job is worked (true without words)."""
    words = F.regexp_extract_all(F.lower(F.coalesce(location, F.lit(""))), F.lit("([a-z]+)"), F.lit(1))
    return F.forall(words, lambda w: w.isin(*WORK_ARRANGEMENT))


def short_error(message: Column, chars: int = 500) -> Column:
    return F.left(message, F.lit(chars))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where whole is 0 or null."""
    return F.when(whole != 0, part / whole)


def midpoint(low: Column, high: Column) -> Column:
    return (low + F.coalesce(high, low)) / 2
