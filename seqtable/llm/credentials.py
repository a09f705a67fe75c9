"""Secrets in texts: plain ones by pattern, weak ones only where complementary parts stand together.

A credential often comes in parts: an identifier (access key id, client id), a
secret that by itself is just a long token, and an endpoint it belongs to. Each
part is an interval of code points. Within a scope (lines up to the next empty
line) the intervals are joined when the gap between them is at most `reach` code
points. A weak candidate is reported only if it is joined to a complementary
part:

    secret      joined to an identifier, or to an endpoint that names a login
    client      joined to a secret
    endpoint    joined to a secret that is itself joined to an identifier

Scopes lie within one document, so the join needs no shuffle; it is a search in
sorted positions, and its work follows the number of parts, not of pairs.

Base spans (`assign`, `access`, `hex`) are always reported.

Results for odd input: null and empty texts have no spans; rows with null or
repeated ids and extra columns are left as they are; an empty table gives an
empty one.
"""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtable.llm.texts import map_rows, map_texts

#: Kinds in the order of their listing; the first three are the base.
KINDS = ("assign", "access", "hex", "secret", "client", "endpoint")
BASE = KINDS[:3]
REACH = 200
MASK = "[secret]"
SPANS = "array<struct<kind:string,start:int,end:int>>"

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

#: A long token with both kinds of letters and digits; weak by itself.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{24,}={0,2}(?![A-Za-z0-9+/=_-])")
CLIENT = re.compile(
    r"""(?i:client_?id|account_?id|access_?key_?id|user_?name|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", re.ASCII
)
ENDPOINT = re.compile(r"[a-z][a-z0-9+.-]{1,20}://[^\s\"'<>]{4,}|(?<![\w.-])(?:[a-z0-9-]{1,63}\.){2,6}[a-z]{2,10}:\d{2,5}(?!\d)", re.ASCII)
LOGIN = re.compile(r"//[^/\s@:]+(:[^/\s@]*)?@")
BREAK = re.compile(r"\n[ \t\r]*\n")
#: Without one of these marks, or an access span, a text has nothing that a token could be joined to.
MARKED = re.compile(r"://|:\d\d|(?i:id|name|login)[\"']?\x20*[:=]", re.ASCII)

Span = tuple[int, int]


def base_spans(text: str) -> dict[str, list[Span]]:
    assigned = "=" in text or ":" in text  # saves the search in most texts
    assign = [m.span() for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST] if assigned else []
    access = [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST] if "AKIA" in text else []
    return {"assign": assign, "access": access, "hex": [m.span() for m in HEX.finditer(text)]}


def near(spans: np.ndarray, others: np.ndarray, scopes: np.ndarray, reach: int) -> np.ndarray:
    """Whether each span has one of `others` in its scope with a gap of at most `reach`.

    Both are (n, 2) arrays sorted by start whose rows don't overlap among
    themselves; scopes are the sorted places where a new scope begins.
    """
    if not len(spans) or not len(others):
        return np.zeros(len(spans), bool)
    scope = np.searchsorted(scopes, spans[:, 0], side="right")
    low = np.concatenate([[0], scopes])[scope]
    high = np.concatenate([scopes, [np.iinfo(np.int64).max]])[scope]
    # The first one that ends within reach of the start; ends ascend as the rows don't overlap.
    first = np.searchsorted(others[:, 1], np.maximum(spans[:, 0] - reach, low + 1), side="left")
    inside = first < len(others)
    there = others[np.minimum(first, len(others) - 1)]
    return inside & (there[:, 0] <= spans[:, 1] + reach) & (there[:, 0] < high) & (there[:, 0] >= low)


def _array(spans: list[Span]) -> np.ndarray:
    return np.array(spans, np.int64).reshape(-1, 2)


def find(text: str | None, reach: int = REACH) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, end exclusive, by start, then by the order of KINDS."""
    if not text:
        return []
    found = base_spans(text)
    if found["access"] or (":" in text or "=" in text) and MARKED.search(text):
        taken = sorted(s for spans in found.values() for s in spans)
        free = lambda m: not any(a < m[1] and m[0] < b for a, b in taken)  # noqa: E731  few spans in a text
        if len(taken) > 64:
            stops = _array(taken)
            most = np.maximum.accumulate(stops[:, 1])
            free = lambda m: (k := np.searchsorted(stops[:, 0], m[1])) == 0 or most[k - 1] <= m[0]
        endpoints = [m.span() for m in ENDPOINT.finditer(text)]
        clients = [m.span() for m in CLIENT.finditer(text) if free(m.span())]
        blocked = sorted([*endpoints, *clients])
        ends = _array(blocked)
        cover = np.maximum.accumulate(ends[:, 1]) if len(ends) else ends[:, 1]
        secrets = []
        for m in TOKEN.finditer(text):
            a, b = m.span()
            k = np.searchsorted(ends[:, 0], b)
            word = m[0]
            if (k == 0 or cover[k - 1] <= a) and free((a, b)) and word.lower() != word and word.upper() != word:
                secrets.append((a, b))
        scopes = np.array([m.end() for m in BREAK.finditer(text)], np.int64)
        s, c, e = _array(secrets), _array(clients), _array(endpoints)
        logins = _array([x for x in endpoints if LOGIN.search(text, *x)])
        ids = _array(sorted([*found["access"], *clients]))
        by_id = near(s, ids, scopes, reach)
        strong = s[by_id]
        s = s[by_id | near(s, logins, scopes, reach)]
        plain = _array(found["assign"])
        found["secret"] = [tuple(x) for x in s.tolist()]
        found["client"] = [tuple(x) for x in c[near(c, s, scopes, reach) | near(c, plain, scopes, reach)].tolist()]
        found["endpoint"] = [tuple(x) for x in e[near(e, strong, scopes, reach)].tolist()]
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(((k, a, b) for k, spans in found.items() for a, b in spans), key=lambda x: (x[1], order[x[0]]))


def scan(documents: DataFrame, keep: list[str], text: str = "text", reach: int = REACH) -> DataFrame:
    """Columns `keep` and `spans`, an array of (kind, start, end) by start."""

    def prepare():
        def work(texts: pa.Array) -> list:
            kinds, starts, ends, bounds = [], [], [], [0]
            for value in texts.to_pylist():
                for kind, start, end in find(value, reach):
                    kinds.append(kind), starts.append(start), ends.append(end)
                bounds.append(len(kinds))
            spans = pa.StructArray.from_arrays(
                [pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["kind", "start", "end"]
            )
            return [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), spans)]

        return work

    return map_texts(documents, keep, text, f"spans {SPANS}", prepare)


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def masked(text: str | None, reach: int = REACH, mask: str = MASK) -> str | None:
    """The text with each span, overlapping ones as one, replaced by a mask."""
    parts, at = [], 0
    for _, start, end in find(text, reach):
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]]) if parts else text


def mask_all(documents: DataFrame, text: str = "text", length: str | None = None, reach: int = REACH) -> DataFrame:
    """The same rows and columns with secrets masked in the text, and the column `length`, if any, set anew."""

    def prepare():
        def work(rows: pa.RecordBatch, texts: pa.Array) -> pa.RecordBatch:
            values = texts.to_pylist()
            changed = [masked(v, reach) for v in values]
            if all(a is b for a, b in zip(values, changed, strict=True)):
                return rows
            columns, names = rows.columns, rows.schema.names
            new = pa.array(changed, texts.type)
            columns[names.index(text)] = new
            if length in names:
                at = names.index(length)
                differs = pa.array([a is not b for a, b in zip(values, changed, strict=True)])
                columns[at] = pc.if_else(differs, pc.utf8_length(new).cast(columns[at].type), columns[at])
            return pa.RecordBatch.from_arrays(columns, names=names)

        return work

    return map_rows(documents, text, prepare)
