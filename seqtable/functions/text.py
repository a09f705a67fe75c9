"""Text normal forms as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from seqtable import constants as K

# The same white space as K.WHITESPACE as a regex class.
WHITESPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def strip(text: Column) -> Column:
    """Trim Unicode white space on both ends (plain ``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(K.WHITESPACE))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def normalize_text(text: Column) -> Column:
    return or_empty(strip(F.lower(text)))


def _without_scheme(url: Column) -> Column:
    bare = F.replace(strip(F.lower(url)), F.lit("https://"), F.lit(""))
    return or_empty(F.replace(bare, F.lit("http://"), F.lit("")))


def normalize_url(url: Column) -> Column:
    """Lower case, no surrounding blanks, no scheme text anywhere, no final slashes."""
    return F.rtrim(_without_scheme(url), F.lit("/"))


def url_path(url: Column) -> Column:
    """Path and query of a URL; empty when there is no slash after the host."""
    bare = _without_scheme(url)
    slash = F.instr(bare, "/")
    return F.when(slash > 0, F.rtrim(F.substr(bare, slash), F.lit("/"))).otherwise(F.lit(""))


def fold_whitespace(text: Column) -> Column:
    """Every run of white space as one space.

    Mapping each kind to a plain space first leaves a pattern of one character;
    a class over all kinds is several times slower per character of text.
    """
    spaced = F.translate(text, K.WHITESPACE, " " * len(K.WHITESPACE))
    return F.regexp_replace(spaced, " {2,}", " ")


def normalize_selector(selector: Column) -> Column:
    """Lower case with every run of white space folded to one space."""
    return or_empty(fold_whitespace(strip(F.lower(selector))))


def slug(text: Column, separator: str = "-") -> Column:
    return F.replace(F.lower(text), F.lit(" "), F.lit(separator))


def humanize(name: Column) -> Column:
    """``e_commerce`` -> ``E Commerce``."""
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def unquote(text: Column) -> Column:
    """Drop blanks, then double, then single quotes around a value."""
    return F.btrim(F.btrim(strip(text), F.lit('"')), F.lit("'"))


def words_in_folded(folded: Column) -> Column:
    """Number of words of a stripped and folded text."""
    spaces = F.length(folded) - F.length(F.replace(folded, F.lit(" "), F.lit("")))
    return spaces + (folded != "").cast("int")


def word_count(text: Column) -> Column:
    """Number of white-space separated words."""
    return words_in_folded(fold_whitespace(strip(text)))


def is_web_url(url: Column) -> Column:
    return F.coalesce(url.rlike(K.URL_PATTERN), F.lit(False))


def is_unsafe_selector(selector: Column) -> Column:
    low = F.lower(selector)
    hit = F.lit(False)
    for part in K.UNSAFE_SELECTOR_PARTS:
        hit = hit | low.contains(part)
    return F.coalesce(hit, F.lit(False))
