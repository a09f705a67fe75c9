"""Token ids of documents in compact files, in the order of the documents' keys.

Documents are sorted by key (range partitions, nulls first, equal keys by text)
and their ids packed into containers of whole documents. A container is one
Parquet row: keys and lengths of its documents, and blocks of at most BLOCK ids,
each coded afresh (see `mixing`) with its number of ids and a CRC-32 of them. Any
container can be read without the others, and any block of it without its neighbours.

    part, place     range partition and container in it; both ascend with the keys
    offset          ids in the partition before this container
    keys, lengths   of the documents in order
    slots           shares of all ids in this container, for order 0; compressed
    blocks          (n, crc, payload)

Files are written by Spark's own committer to the shared folder, so lost tasks
leave nothing behind. Results for odd input: null and empty texts have the end id
alone; repeated and null keys keep a document each; an empty table gives files
without containers. A damaged block is an error that names it.
"""

import functools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqtable.llm.mixing import BLOCK, decode_blocks, encode_blocks, shares
from seqtable.llm.texts import slices, utf8

#: Ids in a container, but for a longer document; pieces of text a worker keeps the ids of; and their words of eight bytes.
CONTAINER, KNOWN, WIDE = 1 << 22, 1 << 20, 4
BLOCKS = "array<struct<n:int,crc:bigint,payload:binary>>"
_KINDS = pa.list_(pa.struct([("n", pa.int32()), ("crc", pa.int64()), ("payload", pa.binary())]))
#: Kinds of bytes.
_OTHER, _BLANK, _MARK, _LETTER, _DIGIT, _LATIN = range(6)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[[*b" \t\n\r"]] = _BLANK
    kinds[[c for c in range(33, 127) if chr(c) != "'"]] = _MARK
    kinds[[c for c in range(128) if chr(c).isalpha()]] = _LETTER
    kinds[[*b"0123456789"]] = _DIGIT
    return kinds


def _borders() -> np.ndarray:
    """Whether a piece may begin at a byte, by the kinds of the byte before and of its own."""
    found = np.zeros((8, 8), bool)
    found[_BLANK], found[:, _BLANK] = True, True
    found[[_LETTER, _LATIN], _MARK] = True
    found[_MARK, [_LETTER, _DIGIT]] = True
    return found.ravel()


_KIND, _BORDER = _kinds().tobytes(), _borders().tobytes().ljust(256, b"\0")


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces begin and end in the UTF-8 bytes of some texts.

    White space and borders between letters and these marks separate words under
    every tokenizer that splits letters from marks. Latin letters are those up to
    U+024F but for İ (U+0130): in lower case it ends with a combining dot, which is a
    mark itself.
    """
    kinds = np.frombuffer(bytearray(data.tobytes().translate(_KIND)), np.uint8)
    lead = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC9))
    code = ((data[lead].astype(np.int32) & 31) << 6) | (data[lead + 1] & 63)
    latin = lead[(code < 0x250) & ~np.isin(code, [0xD7, 0xF7, 0x130])]
    kinds[latin + 1] = _LATIN
    border = np.ones(len(data) + 1, bool)
    border[1:-1] = np.frombuffer(((kinds[:-1] << 3) | kinds[1:]).tobytes().translate(_BORDER), bool)
    border[offsets] = True
    at = np.flatnonzero(border)
    solid = np.flatnonzero(kinds.take(at[:-1]) != _BLANK)
    return at.take(solid), at.take(solid + 1)


def words(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of pieces of at most 8 * WIDE bytes as numbers, filled up with bytes that no text has, and a hash of each piece below them."""
    padded = np.zeros(len(data) // 8 + WIDE + 2, np.uint64)
    padded.view(np.uint8)[: len(data)] = data
    out = np.full((WIDE + 1, len(begins)), _MASKS[8], np.uint64)
    at, hashed = slice(None), np.zeros(len(begins), np.uint64)
    for k in range(WIDE):
        if k:  # the others are filled up
            at = np.flatnonzero(lengths > 8 * k)
        place, shift = begins[at] + 8 * k, ((begins[at] & 7) << 3).astype(np.uint64)
        low, high = padded.take(place >> 3) >> shift, padded.take((place >> 3) + 1) << ((64 - shift) & np.uint64(63))
        high[shift == 0] = 0
        word = low | high | ~_MASKS.take(np.minimum(lengths[at] - 8 * k, 8))
        out[k, at] = word
        word = (hashed[at] ^ word) * _MIX
        hashed[at] = word ^ (word >> np.uint64(29))
    out[-1] = hashed * _MIX
    return out


def spelled(data: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> list[str]:
    """Pieces as strings; no piece holds a blank."""
    ends = np.cumsum(lengths + 1)
    line = data.take(np.repeat(begins - ends + lengths + 1, lengths + 1) + np.arange(ends[-1]), mode="clip")
    line[ends - 1] = ord(" ")
    return line[:-1].tobytes().decode().split(" ")


class Tokens:
    """Ids of texts by a tokenizer file; each distinct piece of text is encoded once while it is known."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("files hold ids below 65,536")
        closes = [str(self.tokenizer.id_to_token(i)).endswith("</w>") for i in range(self.tokenizer.get_vocab_size())]
        self.closes = np.array(closes) if any(closes) else None
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        """Empty tables: words of known pieces, where their ids begin in the pool and how many they are, and places by hash."""
        self.size, room = 0, 1 << 15
        self.words, self.first, self.count = np.zeros((WIDE + 1, room), np.uint64), np.zeros(room, np.int64), np.zeros(room, np.int64)
        self.pool, self.places, self.shift = np.zeros(0, np.uint16), np.full(1 << 16, -1, np.int32), np.uint64(48)

    def encode(self, some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of pieces, where each piece's begin and how many they are.

        Words go in lines of 256 where tokens show the ends of words, all else one by one.
        """
        every: list[np.ndarray] = [np.zeros(0, np.uint16)]
        first, count, used = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64), 0
        single = list(range(len(some)))
        if self.closes is not None:
            alpha = np.fromiter(map(str.isalpha, some), bool, len(some))
            chosen, single = np.flatnonzero(alpha), np.flatnonzero(~alpha).tolist()
            lines = [chosen[i : i + 256] for i in range(0, len(chosen), 256)]
            batch = self.tokenizer.encode_batch_fast([" ".join([some[k] for k in line.tolist()]) for line in lines], add_special_tokens=False)
            for line, encoded in zip(lines, batch, strict=True):
                ids = np.array(encoded.ids, np.uint16)
                ends = np.flatnonzero(self.closes[ids]) + 1
                if len(ends) != len(line):  # some piece is more than one word after all
                    single += line.tolist()
                    continue
                first[line], count[line] = used + np.concatenate([[0], ends[:-1]]), np.diff(ends, prepend=0)
                every.append(ids)
                used += len(ids)
        batch = self.tokenizer.encode_batch_fast([some[k] for k in single], add_special_tokens=False)
        for k, encoded in zip(single, batch, strict=True):
            ids = np.array(encoded.ids, np.uint16)
            first[k], count[k] = used, len(ids)
            every.append(ids)
            used += len(ids)
        return np.concatenate(every), first, count

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of known pieces, -1 for others; all their bytes are compared."""
        slots = (keys[-1] >> self.shift).astype(np.int64)
        out = self.places.take(slots).astype(np.int64)
        left = np.flatnonzero(out >= 0)
        at = out[left]
        while len(left):
            word = keys[0].take(left)
            wrong = self.words[0].take(at) != word
            on = np.arange(len(left))
            for k in range(1, WIDE):  # only a piece that fills a word can differ beyond it
                on = on[word >> np.uint64(56) != 255]
                word = keys[k].take(left[on])
                wrong[on] |= self.words[k].take(at[on]) != word
            left = left[wrong]
            slots[left] = (slots[left] + 1) & (len(self.places) - 1)
            out[left] = self.places[slots[left]]
            left = left[out[left] >= 0]
            at = out[left]
        return out

    def enter(self, numbers: np.ndarray) -> None:
        """Put known pieces into the places by hash."""
        slots = (self.words[-1, numbers] >> self.shift).astype(np.int64)
        while len(numbers):
            free = self.places[slots] < 0
            self.places[slots[free]] = numbers[free]  # of two that meet, one stays
            left = self.places[slots] != numbers
            numbers, slots = numbers[left], (slots[left] + 1) & (len(self.places) - 1)

    def learn(self, keys: np.ndarray, some: list[str]) -> None:
        """Keep the ids of pieces that are not known yet."""
        ids, first, count = self.encode(some)
        known, self.size = self.size, self.size + len(some)
        if self.size > len(self.first):
            more = 1 << self.size.bit_length()
            self.words, self.first, self.count = (
                np.concatenate([x[..., :known], np.zeros((*x.shape[:-1], more - known), x.dtype)], axis=-1) for x in (self.words, self.first, self.count)
            )
            self.places, self.shift = np.full(2 * more, -1, np.int32), np.uint64(64 - (2 * more).bit_length() + 1)
            self.enter(np.arange(known))
        new = slice(known, self.size)
        self.words[:, new], self.first[new], self.count[new] = keys, len(self.pool) + first, count
        self.pool = np.concatenate([self.pool, ids])
        self.enter(np.arange(known, self.size))

    def __call__(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """Ids as little-endian 16-bit numbers."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        data, offsets = utf8(texts)
        begins, ends = pieces(data, offsets)
        lengths = ends - begins
        if self.size > KNOWN:
            self.forget()
        keys = words(data, begins, lengths)
        long = np.flatnonzero(lengths > 8 * WIDE)
        known = np.ones(len(begins), bool)
        known[long] = False
        number = self.find(keys)
        while len(new := np.flatnonzero((number < 0) & known)):
            _, once = np.unique(keys[-1, new], return_index=True)
            self.learn(keys[:, new[once]], spelled(data, begins[new[once]], lengths[new[once]]))
            number[new] = self.find(keys[:, new])
        pool, number[long] = self.pool, 0
        first, count = self.first.take(number), self.count.take(number)
        if len(long):
            some = spelled(data, begins[long], lengths[long])
            place = {piece: k for k, piece in enumerate(dict.fromkeys(some))}
            ids, begin, n = self.encode(list(place))
            at = np.array([place[piece] for piece in some])
            first[long], count[long] = len(pool) + begin[at], n[at]
            pool = np.concatenate([pool, ids])
        ends = np.concatenate([[0], np.cumsum(count)])
        ids = pool.take(np.repeat(first - ends[:-1], count) + np.arange(ends[-1])).astype("<u2")
        bounds = ends[np.searchsorted(begins, offsets)].tolist()
        out = [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
        whole = np.zeros(len(texts), bool)
        for token in self.special:
            whole |= pc.fill_null(pc.match_substring(texts, token), False).to_numpy(zero_copy_only=False)
        for k in np.flatnonzero(whole).tolist():  # a special token can swallow the borders beside it
            out[k] = np.array(self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids, "<u2").tobytes()
        return out


@functools.lru_cache(maxsize=1)
def tokens(path: str) -> Tokens:
    """One for each worker process."""
    return Tokens(path)


def packed(ids: list[bytes], slots: np.ndarray | None = None) -> list[tuple[int, int, bytes]]:
    """Blocks (n, crc, payload) of the ids of some documents, one after the other."""
    every = np.frombuffer(b"".join(ids), "<u2")
    blocks = [every[i : i + BLOCK] for i in range(0, len(every), BLOCK)]
    return [(len(b), zlib.crc32(b.astype("<u4").tobytes()), raw) for b, raw in zip(blocks, encode_blocks(blocks, slots), strict=True)]


def unpacked(blocks: list[dict], name: str, slots: np.ndarray | None = None) -> np.ndarray:
    """All ids of the blocks; an error if one doesn't match its checksum."""
    found = decode_blocks([b["payload"] for b in blocks], np.array([b["n"] for b in blocks], np.int64), slots)
    for k, (block, ids) in enumerate(zip(blocks, found, strict=True)):
        if zlib.crc32(ids.astype("<u4").tobytes()) != block["crc"]:
            raise ValueError(f"block {k} of container {name} is damaged")
    return np.concatenate([np.zeros(0, np.uint16), *found])


def write(documents: DataFrame, folder: str, tokenizer_path: str, end: int, key: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all documents, each closed by the id `end`, to files in a new folder."""
    rows = documents.select(documents[key].cast("bigint").alias("key"), documents[text].alias("text"))
    # Rows with one key are split by the beginnings of their texts.
    rows = rows.repartitionByRange("key", F.substring("text", 1, 64)).sortWithinPartitions("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spell, part = tokens(tokenizer_path), TaskContext.get().partitionId()
        closing = np.array([end], "<u2").tobytes()
        keys: list = []
        ids: list[bytes] = []
        held = place = offset = 0

        def container() -> pa.RecordBatch:
            columns = [[part], [place], [offset], [keys], [[len(i) // 2 for i in ids]]]
            slots = shares(np.frombuffer(b"".join(ids), "<u2"))
            columns.append([zlib.compress(slots.astype("<u4").tobytes())])
            blocks = [dict(zip(("n", "crc", "payload"), b, strict=True)) for b in packed(ids, slots)]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*arrays, pa.array([blocks], _KINDS)], names=["part", "place", "offset", "keys", "lengths", "slots", "blocks"])

        for batch in batches:
            for rows in slices(batch, 1):
                for k, raw in zip(rows.column(0).to_pylist(), spell(rows.column(1)), strict=True):
                    raw += closing
                    if ids and held + len(raw) // 2 > CONTAINER:
                        yield container()
                        keys, ids, place, offset, held = [], [], place + 1, offset + held, 0
                    keys.append(k)
                    ids.append(raw)
                    held += len(raw) // 2
        if ids:
            yield container()

    schema = f"part int, place int, offset bigint, keys array<bigint>, lengths array<bigint>, slots binary, blocks {BLOCKS}"
    rows.mapInArrow(run, schema).write.option("compression", "uncompressed").parquet(folder)


def read(spark: SparkSession, folder: str, make: Callable[[np.ndarray], dict], made: str) -> DataFrame:
    """key, start (ids of all documents before it), n_tokens and what `make` makes of each document's ids.

    Only one number per range partition passes the driver: where its ids begin.
    """
    files = spark.read.parquet(folder)
    sizes = files.groupBy("part").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, n: a + n)).alias("n"))
    base, total = {}, 0
    for r in sorted(sizes.collect()):
        base[r.part] = total
        total += r.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, place, offset, keys, lengths, slots, blocks = (batch.column(i)[row].as_py() for i in range(7))
                ids = unpacked(blocks, f"{part}/{place}", np.frombuffer(zlib.decompress(slots), "<u4").astype(np.int64))
                ends = np.cumsum(lengths)
                begins = ends - lengths
                out = [{"key": k, "start": base[part] + offset + int(a), "n_tokens": n, **make(ids[a : a + n])} for k, a, n in zip(keys, begins, lengths, strict=True)]
                yield pa.RecordBatch.from_pylist(out)

    found = files.select("part", "place", "offset", "keys", "lengths", "slots", "blocks")
    return found.mapInArrow(run, f"key bigint, start bigint, n_tokens bigint, {made}")


def checksum(ids: np.ndarray) -> dict:
    """CRC-32 of the ids as little-endian 32-bit numbers."""
    return {"ids_crc32": zlib.crc32(ids.astype("<u4").tobytes())}


def all_ids(ids: np.ndarray) -> dict:
    return {"ids": ids.astype("<u4").tobytes()}
