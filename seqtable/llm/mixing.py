"""Adaptive coding of token ids: distributions of orders 0 to 2, mixed with adaptive weights, drive a range coder.

Ids are cut into blocks that start afresh. Blocks of a batch advance together,
one lane each, so every step is a few numpy calls for all of them.

Order 0 gives every id its share of a table of SLOTS, by its counts in a container
of blocks (all ids alike, if no table is given). Order 2 and order 1 each put all on
one id, the one that followed this hashed context last, and tell how often it held.
The probability of an id is the sum of what the three give it, each by its weight:
guesses that agree add up. Weights are kept for each pair of confidences and moved
towards what held after every id. In the range, ids lie in ascending order and what
the guesses add to an id comes first, so the sum is inverted without a search.

All numbers are integers, so every machine decodes what any machine encoded.
"""

import numpy as np

#: Ids in a block, bits of a context's place in the tables of guesses, and blocks that advance together.
BLOCK, CONTEXTS, LANES = 2048, 9, 2048
IDS = 1 << 16
#: Bits of the slots of order 0, of a weight, and of both, the unit of all probabilities.
_SLOT, _WEIGHT = 18, 8
_UNIT = _SLOT + _WEIGHT
SLOTS = 1 << _SLOT
#: Weights have eight more bits while they are kept; a step moves them by a sixteenth.
_ALL, _TOP, _SUM, _RATE = np.int32((1 << 16) - 1), np.int32(0xFF00), np.int32(1 << _WEIGHT), 4
#: Weights of orders 2 and 1 at first, by confidence; the largest two stay below _ALL.
_FIRST = np.array([[0, 20_000, 30_000, 40_000], [0, 6_000, 12_000, 20_000]])
#: Contexts are hashed by products with this odd number (2654435761, modulo 2 ** 32).
#: Eight guesses of order 2 and eight of order 1 lie side by side, for the same hashed last ids.
_HASH, _PLACE, _EIGHT = np.int32(-1_640_531_535), np.int32((1 << CONTEXTS) - 1), np.int32(7)
_WORD, _ONE = 1 << 32, np.uint64(1)


def shares(ids: np.ndarray) -> np.ndarray:
    """Slots of all ids by their counts; at least one for each id that occurs."""
    counts = np.bincount(ids, minlength=IDS)
    some = np.count_nonzero(counts)
    slots = (counts > 0) + counts * (SLOTS - some) // max(len(ids), 1)
    slots[counts.argmax()] += SLOTS - slots.sum()
    return slots


class Writer:
    """64-bit range coders, one for each lane, with 32-bit words; carries beyond a word are added up at the end."""

    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
        # Words in the order they are settled, with their lanes; a step moves on one word of a lane at most.
        self.words, self.lanes, self.used = np.zeros(lanes * 8, np.uint64), np.zeros(lanes * 8, np.uint16), 0
        self.place = np.zeros(lanes, np.int64)

    def narrow(self, start: np.ndarray, size: np.ndarray) -> None:
        """Take the part [start, start + size) of the first lanes' ranges."""
        m = len(start)
        unit, low = self.range[:m] >> _UNIT, self.low[:m]
        more, width = start.astype(np.uint64) * unit, size.astype(np.uint64) * unit
        low += more
        over = np.flatnonzero(low < more)
        self.words[self.place.take(over)] += _ONE
        at = np.flatnonzero(width < _WORD)
        settled = low.take(at)
        self.add(at, settled >> 32)
        low[at] = settled << 32
        width[at] <<= 32
        self.range[:m] = width

    def add(self, at: np.ndarray, words: np.ndarray) -> None:
        end = self.used + len(at)
        if end > len(self.words):
            self.words, self.lanes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.words, self.lanes))
        self.words[self.used : end], self.lanes[self.used : end] = words, at
        self.place[at] = np.arange(self.used, end)
        self.used = end

    def finish(self) -> list[bytes]:
        every = np.arange(len(self.low))
        for part in (self.low >> 32, self.low & (_WORD - 1)):
            self.add(every, part)
        lanes = self.lanes[: self.used]
        words = self.words[: self.used].take(np.argsort(lanes, kind="stable"))
        while len(over := np.flatnonzero(words >= _WORD)):  # never the first word of a lane
            words[over] -= np.uint64(_WORD)
            words[over - 1] += _ONE
        raw, ends = words.astype("<u4").tobytes(), 4 * np.cumsum(np.bincount(lanes, minlength=len(every)))
        return [raw[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]


class Reader:
    """The other side of `Writer`: what is left of the range below a lane's code."""

    def __init__(self, payloads: list[bytes]):
        wide = max(map(len, payloads), default=0) // 4 + 2
        data = np.zeros((len(payloads), wide), np.uint32)
        for k, raw in enumerate(payloads):
            data[k, : len(raw) // 4] = np.frombuffer(raw[: len(raw) // 4 * 4], "<u4")
        self.code = (data[:, 0].astype(np.uint64) << 32) | data[:, 1]
        self.range = np.full(len(payloads), (1 << 64) - 1, np.uint64)
        self.words, self.last = data.reshape(-1), (np.arange(len(payloads)) + 1) * wide - 1
        self.place = np.arange(len(payloads)) * wide + 2

    def value(self, m: int) -> np.ndarray:
        """Where the first lanes' codes lie in their ranges."""
        self.unit = self.range[:m] >> _UNIT
        return (self.code[:m] // self.unit).astype(np.int32)

    def narrow(self, start: np.ndarray, size: np.ndarray) -> None:
        m = len(start)
        code, width = self.code[:m], size.astype(np.uint64) * self.unit
        code -= start.astype(np.uint64) * self.unit
        at = np.flatnonzero(width < _WORD)
        place = np.minimum(self.place.take(at), self.last.take(at))  # damaged data may end early; the checksum tells
        code[at] = (code.take(at) << 32) | self.words.take(place)
        self.place[at] = place + 1
        width[at] <<= 32
        self.range[:m] = width


class Model:
    """Guesses and weights of all lanes, each table flat over orders and lanes."""

    def __init__(self, lanes: int, slots: np.ndarray | None):
        slots = np.full(IDS, SLOTS // IDS) if slots is None else slots
        self.width, self.begin = slots.astype(np.int32), (np.cumsum(slots) - slots).astype(np.int32)
        self.owner = np.repeat(np.arange(IDS, dtype=np.uint16), slots)
        room = np.zeros((2 * lanes << CONTEXTS) + 16, np.int32)
        # From a border of 64 bytes on, so that guesses that lie side by side come to the processor together.
        self.guesses = room[-room.ctypes.data % 64 // 4 :][: 2 * lanes << CONTEXTS]
        self.tables = (np.arange(lanes) << CONTEXTS + 1) + np.array([[0], [8]])
        first = np.stack([np.repeat(_FIRST[0], 4), np.tile(_FIRST[1], 4)])
        self.weights = np.tile(first[:, None], (1, lanes, 1)).astype(np.int32).reshape(-1)
        self.pairs = (np.arange(2 * lanes) * 16).reshape(2, lanes)
        self.last, self.before = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)

    def token(self, coder: Writer | Reader, m: int, ids: np.ndarray | None) -> np.ndarray:
        """Code one id in each of the first m lanes; returns the ids."""
        last, before = self.last[:m], self.before[:m]  # both hashed
        places = self.tables[:, :m].copy()
        near = last >> (32 - CONTEXTS) & _PLACE
        line = (near & ~_EIGHT) << 1
        places[0] += line + ((last + before) >> 29 & _EIGHT)
        places[1] += line + (near & _EIGHT)
        held = self.guesses.take(places)
        guess, trust = held >> 2, held & 3
        pairs = self.pairs[:, :m] + ((trust[0] << 2) + trust[1])
        weights = self.weights.take(pairs)
        mass = (weights & _TOP) << (_SLOT - 8)
        rest = _SUM - ((mass[0] + mass[1]) >> _SLOT)
        if ids is None:
            past = self.begin.take(guess) * rest
            order = (guess[0] - guess[1]) >> 31  # all bits, if the guess of order 2 is the smaller id
            past[0] += mass[1] & ~order
            past[1] += mass[0] & order
            value = coder.value(m)
            np.subtract(value, past, out=past)
            np.minimum(np.maximum(past, 0, out=past), mass, out=past)
            value -= past[0]
            value -= past[1]
            ids = self.owner.take((value / rest).astype(np.int64), mode="clip").astype(np.int32)
        holds = guess == ids
        held_now = holds.astype(np.int32)
        own = mass * held_now
        below = mass & ((guess - ids) >> 31)
        coder.narrow(self.begin.take(ids) * rest + (below[0] + below[1]), self.width.take(ids) * rest + (own[0] + own[1]))
        self.guesses[places] = np.where(holds, np.minimum(held + 1, held | 3), (ids << 2) + 1)
        held_now[1] -= held_now[0] & held_now[1]
        weights += (held_now * _ALL - weights) >> _RATE
        self.weights[pairs] = weights
        self.before[:m] = last
        self.last[:m] = ids * _HASH
        return ids


def _groups(n: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Blocks that advance together, longest first, and how many of them have an id at each step."""
    order = np.argsort(-n, kind="stable")
    groups = [order[i : i + LANES] for i in range(0, len(order), LANES)]
    return [(g, len(g) - np.searchsorted(n[g][::-1], np.arange(int(n[g].max())), side="right")) for g in groups]


def encode_blocks(blocks: list[np.ndarray], slots: np.ndarray | None = None) -> list[bytes]:
    """Payloads of blocks of ids below 65,536, all of which have slots."""
    if slots is not None and any((slots.take(b) == 0).any() for b in blocks):
        raise ValueError("ids without a slot")
    out = [b""] * len(blocks)
    for group, live in _groups(np.array([len(b) for b in blocks], np.int64)):
        ids = np.zeros((len(group), len(live)), np.uint16)
        for k, block in enumerate(group.tolist()):
            ids[k, : len(blocks[block])] = blocks[block]
        model, coder = Model(len(group), slots), Writer(len(group))
        for row, m in zip(np.ascontiguousarray(ids.T), live.tolist(), strict=True):
            model.token(coder, m, row[:m].astype(np.int32))
        for block, raw in zip(group.tolist(), coder.finish(), strict=True):
            out[block] = raw
    return out


def decode_blocks(payloads: list[bytes], n: np.ndarray, slots: np.ndarray | None = None) -> list[np.ndarray]:
    """The ids of blocks with these numbers of ids, by the slots they were encoded with."""
    out = [np.zeros(0, np.uint16)] * len(payloads)
    for group, live in _groups(n):
        ids = np.zeros((len(live), len(group)), np.uint16)
        model, coder = Model(len(group), slots), Reader([payloads[k] for k in group.tolist()])
        for row, m in zip(ids, live.tolist(), strict=True):
            row[:m] = model.token(coder, m, None)
        ids = np.ascontiguousarray(ids.T)
        for k, block in enumerate(group.tolist()):
            out[block] = ids[k, : n[block]]
    return out
