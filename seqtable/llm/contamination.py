"""Benchmark passages in documents, by a prefix-filtered join with exact checks.

An item is the set of its windows (13 neighbouring words; a shorter item is one
window), and a window is the set of its shingles (3 neighbouring words). A window
occurs in a document only if all its shingles do, so the necessary prefix at full
containment is one shingle: the one that the fewest places of all documents hold.
The steps:

1. Count in all documents how often each shingle of the benchmark occurs.
2. Choose for each window its rarest shingle (ties: the first in the window).
3. Join the shingles of each document with these. A hit names a window and the
   place where it would begin; bounds on the document's length and on that place
   come first, then the words of the window are compared one by one.

The benchmark is read in blocks of bounded size (a few MB), each sent to the
tasks as a whole; the documents pass through one Arrow step per block and are
never shuffled, so hot sources, frequent words and groups of copies cost what
other rows cost. A benchmark beyond the bound makes more blocks, not larger ones.

Words are compared as 64-bit numbers of their bytes. Results for odd input: null
texts have no words; items without words or with a null text or id are never
found; items that share an id count as one; documents that repeat or have a null
id get a row each; an empty benchmark finds nothing.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqtable.llm.tables import HashTable
from seqtable.llm.texts import map_texts
from seqtable.llm.words import ALPHANUMERIC, runs, words

WINDOW, SHINGLE = 13, 3
#: Words of benchmark text in a block.
BLOCK_WORDS = 500_000


@dataclass
class Block:
    """Windows of some items: their words in one array, and for each its item."""

    words: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    items: np.ndarray
    names: list[str]
    #: Distinct shingles of all windows, by size of shingle, and how often documents have them.
    shingles: dict[int, np.ndarray]
    counts: dict[int, np.ndarray]

    def shingle_size(self) -> np.ndarray:
        return np.minimum(self.sizes, SHINGLE)

    def shingle_runs(self, size: int) -> np.ndarray:
        """Numbers of the runs of `size` words, by place in `words`."""
        return runs(np.concatenate([self.words, np.zeros(size - 1, np.uint64)]), size)


def blocks(benchmark: DataFrame, key: str, text: str, window: int, most: int) -> Iterator[Block]:
    """Blocks of at most about `most` words of benchmark text (a longer item makes its own)."""
    rows = benchmark.select(benchmark[key].alias("key"), benchmark[text].alias("text")).filter("key is not null and text is not null")
    names, parts, held = [], [], 0
    for r in rows.toLocalIterator():
        numbers, _ = words(pa.array([r.text]), ALPHANUMERIC)
        if len(numbers):
            names.append(str(r.key))
            parts.append(numbers)
            held += len(numbers)
        if held >= most:
            yield _block(names, parts, window)
            names, parts, held = [], [], 0
    if names:
        yield _block(names, parts, window)


def _block(names: list[str], parts: list[np.ndarray], window: int) -> Block:
    length = np.array([len(p) for p in parts])
    n = np.maximum(length - window + 1, 1)
    first = np.cumsum(length) - length
    items = np.repeat(np.arange(len(parts)), n)
    starts = first[items] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    block = Block(np.concatenate(parts), starts, np.minimum(length, window)[items], items, names, {}, {})
    for size in np.unique(block.shingle_size()).tolist():
        block.shingles[size] = np.unique(block.shingle_runs(size)[_places(block, size)[1]])
    return block


def _places(block: Block, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, places in `words`, and offsets in the window of the shingles of this size."""
    chosen = np.flatnonzero(block.shingle_size() == size)
    n = block.sizes[chosen] - size + 1
    owner = np.repeat(chosen, n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return owner, block.starts[owner] + offset, offset


def count_shingles(documents: DataFrame, block: Block, text: str) -> None:
    """Fill in how often each shingle occurs in all documents; one small row per slice and shingle found."""

    def prepare():
        tables = {s: HashTable(k, np.arange(len(k), dtype=np.int32)) for s, k in block.shingles.items()}

        def work(texts: pa.Array) -> list:
            numbers, bounds = words(texts, ALPHANUMERIC)
            found = []
            for size, table in tables.items():
                seen = table.find(runs(numbers, size))
                # Runs across the border of two texts are counted too; that shifts no result.
                where, n = np.unique(seen[seen >= 0], return_counts=True)
                found += [{"size": size, "shingle": int(w), "n": int(c)} for w, c in zip(where, n, strict=True)]
            return [[found, *[[]] * (len(texts) - 1)]]

        return work

    seen = map_texts(documents, [], text, "found array<struct<size:int,shingle:int,n:bigint>>", prepare)
    sums = seen.select(F.inline("found")).groupBy("size", "shingle").agg(F.sum("n").alias("n"))
    block.counts = {s: np.zeros(len(k), np.int64) for s, k in block.shingles.items()}
    for r in sums.collect():  # as many rows as the block has shingles, at most
        block.counts[r["size"]][r["shingle"]] = r["n"]


class Join:
    """Finds the places of a block's windows in documents."""

    def __init__(self, block: Block):
        self.block, self.tables = block, {}
        for size, keys in block.shingles.items():
            owner, place, offset = _places(block, size)
            shingle = np.searchsorted(keys, block.shingle_runs(size)[place])
            rank = block.counts[size][shingle]
            order = np.lexsort((offset, rank, owner))
            _, first = np.unique(owner[order], return_index=True)
            prefix = order[first]  # of each window its rarest shingle
            by = prefix[np.argsort(shingle[prefix], kind="stable")]
            distinct, start, n = np.unique(shingle[by], return_index=True, return_counts=True)
            table = HashTable(keys[distinct], np.arange(len(distinct), dtype=np.int32))
            self.tables[size] = (table, start, n, owner[by], offset[by])

    def __call__(self, numbers: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, place of its first word) of all occurrences in texts with these bounds."""
        block, windows, places = self.block, [], []
        for size, (table, start, n, owner, offset) in self.tables.items():
            slot = table.find(runs(numbers, size))
            at = np.flatnonzero(slot >= 0)
            slot = slot[at]
            times = n[slot]
            pick = np.repeat(start[slot], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            window, place = owner[pick], np.repeat(at, times) - offset[pick]
            text = np.searchsorted(bounds, np.repeat(at, times), side="right") - 1
            fits = (place >= bounds[text]) & (place + block.sizes[window] <= bounds[text + 1])
            window, place = window[fits], place[fits]
            for k in range(int(block.sizes.max(initial=0))):
                # Most false hits go with the first words compared.
                same = (k >= block.sizes[window]) | (numbers[np.minimum(place + k, len(numbers) - 1)] == block.words[np.minimum(block.starts[window] + k, len(block.words) - 1)])
                window, place = window[same], place[same]
            windows.append(window)
            places.append(place)
        return np.concatenate([*windows, np.zeros(0, np.int64)]).astype(np.int64), np.concatenate([*places, np.zeros(0, np.int64)]).astype(np.int64)


STATE = ["__n_words", "__hits", "__items"]
MADE = "__n_words bigint, __hits array<struct<start:int,end:int>>, __items array<string>"


def find(
    documents: DataFrame, benchmark: DataFrame, keep: list[str], text: str = "text", item_key: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Columns `keep`, then n_words, hits (runs of hit words: start, end) and items (ids as text, sorted) of each document."""
    found = _search(documents, benchmark, keep, text, item_key, item_text, window, block_words)
    return found.select(
        *[F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep)],
        *[F.col(s).alias(s.removeprefix("__")) for s in STATE],
    )


def keep_clean(documents: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows, all columns, that are not contaminated."""
    found = _search(documents, benchmark, documents.columns, text, item_key, item_text, WINDOW, BLOCK_WORDS)
    clean = found.filter(~contaminated(F.col("__hits"), F.col("__n_words")))
    return clean.select(*[F.col(f"__keep{i}").alias(c) for i, c in enumerate(documents.columns)])


def _search(documents: DataFrame, benchmark: DataFrame, keep: list[str], text: str, item_key: str, item_text: str, window: int, block_words: int) -> DataFrame:
    """Columns `keep` as __keep0 and so on, and what was found; the text goes along only as long as it is needed."""
    kept = [f"__keep{i}" for i in range(len(keep))]
    frame = documents.select(*[documents[c].alias(k) for c, k in zip(keep, kept, strict=True)], *([] if text in keep else [documents[text].alias("__text")]))
    column = kept[keep.index(text)] if text in keep else "__text"
    found: list[str] = []
    waiting: Block | None = None
    for block in blocks(benchmark, item_key, item_text, window, block_words):
        count_shingles(documents, block, text)
        if waiting:
            frame = _scan(frame, list(dict.fromkeys([*kept, column])), column, found, waiting)
            found = STATE
        waiting = block
    return _scan(frame, kept, column, found, waiting)


def _scan(frame: DataFrame, kept: list[str], text: str, found: list[str], block: Block | None) -> DataFrame:
    """Columns `kept`, and what the windows of one block find joined to what the blocks before have `found`."""

    def prepare():
        join = Join(block) if block else None

        def work(texts: pa.Array) -> list:
            numbers, bounds = words(texts, ALPHANUMERIC)
            hits: list[list] = [[] for _ in range(len(texts))]
            items: list[list] = [[] for _ in range(len(texts))]
            window, place = join(numbers, bounds) if join else (np.zeros(0, np.int64),) * 2
            owner = np.searchsorted(bounds, place, side="right") - 1
            for k in np.unique(owner).tolist():
                mine = owner == k
                begin = place[mine] - bounds[k]
                hits[k] = merged(begin, begin + block.sizes[window[mine]])
                items[k] = sorted({block.names[i] for i in np.unique(block.items[window[mine]])})
            structs = [[{"start": a, "end": b} for a, b in h] for h in hits]
            return [np.diff(bounds), structs, items]

        return work

    if not found:
        return map_texts(frame, kept, text, MADE, prepare)
    frame = map_texts(frame, [*kept, *found], text, MADE.replace("__", "__new_"), prepare)
    return frame.select(
        *kept,
        "__n_words",
        _union(F.concat("__hits", "__new_hits")).alias("__hits"),
        F.array_sort(F.array_union("__items", "__new_items")).alias("__items"),
    )


def _union(spans: Column) -> Column:
    """Runs that touch or overlap as one, by start."""
    kind = "array<struct<start:int,end:int>>"

    def add(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        grown = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(s["start"] <= last["end"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast(kind), add)


def merged(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Intervals that touch or overlap as one, by start."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    fresh = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    return list(zip(start[fresh].tolist(), reach[np.append(fresh[1:], len(reach)) - 1].tolist(), strict=True))


def n_hit(hits: Column) -> Column:
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda n, h: n + h["end"] - h["start"])


def contaminated(hits: Column, n_words: Column) -> Column:
    """A twentieth of the words or more stand in windows of the benchmark."""
    n = n_hit(hits)
    return (n > 0) & (20 * n >= n_words)
