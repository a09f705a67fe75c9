"""Redaction of personal data and secrets in texts, in one scan, with built-in expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtable.functions.staging import computed_once

#: At each place the first kind that matches counts. Every repeat that others follow is bounded, so a
#: scan takes time in proportion to the text. Borders (\b) are those of ASCII letters, digits and _.
KINDS: dict[str, str] = {
    "email": r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(\.[A-Za-z0-9-]{1,63}){0,8}\.[A-Za-z]{2,24}",
    "secret": r"(AKIA[A-Z0-9]{12,}|(password|passwd|secret|token|api_?key)[ ]{0,8}[:=][ ]{0,8}[A-Za-z0-9+/_.=-]{8,})",
    "card": r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    "ip": r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b",
    "phone": r"(\+[0-9]{1,3}[ .-]?)?(\([0-9]{3}\)|\b[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}\b",
}
#: One alternation of all kinds, for one scan.
ANY_KIND = "|".join(f"({p})" for p in KINDS.values())


_PART = "[A-Za-z0-9._%+-]"
#: Stands around finds while a text is cut; and a run for which an email's first part may begin in its middle.
_SIGN, _LONG_RUN = "\x01", f"(?<!{_PART}){_PART}{{65}}"


def _for_java(pattern: str) -> str:
    """The same finds in Java's syntax: ASCII borders, and no second try of an email's first part without its @."""
    pattern = pattern.replace(r"\b[", "(?<![A-Za-z0-9_])[").replace(r"\b", "(?![A-Za-z0-9_])")
    return pattern.replace("{1,64}@", "{1,64}+@")


def _for_short_runs() -> str:
    """The finds of `ANY_KIND` in texts without a long run, where most places are passed after a look at one letter.

    There the first email begins where its run does, or where the find before it ended.
    """
    email, secret, *numbers = (f"({_for_java(p)})" for p in KINDS.values())
    return rf"(?:(?<!{_PART})|\G){email}|(?=[Aapst]){secret}|(?=[0-9+(])(?:{'|'.join(numbers)})"


def luhn(digits: Column) -> Column:
    """Whether the check digit of a number, given as digits, is right."""
    each = F.split(digits, "")
    weighed = F.transform(each, lambda d, i: d.cast("int") * F.when((F.length(digits) - i) % 2 == 0, 2).otherwise(1))
    total = F.aggregate(weighed, F.lit(0), lambda s, d: s + d - F.when(d > 9, 9).otherwise(0))
    return total % 10 == 0


def _kind(find: Column) -> Column:
    """The kind of a find; null if its check fails (card: Luhn's sum; ip: parts up to 255)."""
    sound = {
        "card": luhn(F.regexp_replace(find, "[^0-9]", "")),
        "ip": F.forall(F.split(find, r"\."), lambda part: part.cast("int") <= 255),
    }
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(KINDS.items()):
        kind = F.when(find.rlike(f"^(?:{pattern})$"), F.when(sound.get(name, F.lit(True)), name)).otherwise(kind)
    return kind


def _pieces(text: Column) -> Column:
    """The text cut at its finds in one scan: what is before, the first find, what is between, and so on; null for texts that need two."""
    odd = F.contains(text, F.lit(_SIGN)) | (F.contains(text, F.lit("@")) & text.rlike(_LONG_RUN))
    return F.when(~odd, F.split(F.regexp_replace(text, _for_short_runs(), f"{_SIGN}$0{_SIGN}"), _SIGN, -1))


def _cut(text: Column, pieces: Column) -> tuple[Column, Column]:
    """The finds, and what is before, between and behind them."""
    pattern, cut = _for_java(ANY_KIND), pieces.isNotNull()
    finds = F.when(cut, F.filter(pieces, lambda _, i: i % 2 == 1)).otherwise(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return finds, F.when(cut, F.filter(pieces, lambda _, i: i % 2 == 0)).otherwise(F.split(text, pattern, -1))


def _results(text: Column, finds: Column, rest: Column, kinds: Column) -> tuple[Column, dict[str, Column]]:
    """The redacted text, and n_<kind>."""
    shown = F.zip_with(finds, kinds, lambda find, kind: F.coalesce(F.concat(F.lit("["), kind, F.lit("]")), find))
    pieces = F.zip_with(shown, F.slice(rest, F.lit(2), F.size(finds)), lambda find, rest: F.concat(find, rest))
    of_kind = lambda kind: F.size(F.filter(kinds, lambda x: x == kind))
    named = {f"n_{k}": F.when(text.isNull(), 0).otherwise(of_kind(k)).cast("bigint") for k in KINDS}
    return F.concat(F.element_at(rest, 1), F.array_join(pieces, "")), named


def redact(rows: DataFrame | Column, column: str | None = None, redacted: str | None = None) -> DataFrame | tuple[Column, dict[str, Column]]:
    """The rows with the column's text redacted as ``redacted``, and n_<kind>: the finds of each kind.

    A find is replaced by its kind in brackets; one that fails its check stays as it
    is. The text is cut at the finds once, and only the finds are looked at again.
    Of a text column alone: the redacted text and the counts, as columns.
    """
    if isinstance(rows, Column):
        finds, rest = _cut(rows, _pieces(rows))
        return _results(rows, finds, rest, F.transform(finds, _kind))
    text = F.col(column)
    rows = computed_once(rows.withColumn("_pieces", _pieces(text)), "_pieces")
    finds, rest = _cut(text, F.col("_pieces"))
    rows = computed_once(rows.withColumns({"_finds": finds, "_rest": rest}), "_finds", "_rest").drop("_pieces")
    rows = computed_once(rows.withColumn("_kinds", F.transform("_finds", _kind)), "_kinds")
    found, named = _results(text, F.col("_finds"), F.col("_rest"), F.col("_kinds"))
    return rows.withColumns({**named, redacted: found}).drop("_finds", "_rest", "_kinds")
