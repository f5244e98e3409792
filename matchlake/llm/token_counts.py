"""Token counts by a compiled finite-state transducer.

A byte-level BPE tokenizer (splitting pattern plus ranked merges) is turned
into one deterministic transducer over text bytes. Each transition carries the
change in the number of tokens the text would have if it ended there, so the
sum along a path is the token count.

* The splitting pattern is a machine with a handful of modes (letters, digits,
  other, white space with its last character held back, apostrophe forms).
* Inside one piece the merge state is the longest suffix that can still grow
  into a vocabulary entry, with the last token (and relative count) at every
  position in it where a longer token could start. A byte sequence has exactly
  one segmentation whose neighbouring tokens are all stable under the merges,
  so the last token of a longer prefix follows from that window.
* States are numbered as they are met and kept in a dense transition table; the
  table is rebuilt from the states in use when it reaches its size bound, so a
  worker's memory does not depend on the text.

Texts are cut into chunks which all run in lockstep, one table look-up per byte
and lane. A chunk is a state map: a head that depends on the entry state, up to
the first white space that follows a non-space byte, and a tail that does not,
because that white space always opens a new piece. Chunk maps compose
associatively; a parallel prefix scan over the chunks of each text gives every
head its entry, and one more lockstep run evaluates all heads.

Null and empty texts have 0 tokens. Rows are counted one by one, so repeated
rows and ids need no care. Extra columns pass through; a column of the input
named like an output is replaced.
"""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from tokenizers.pre_tokenizers import ByteLevel

from matchlake.llm.batches import slices

CHUNK = 1024
MAX_CELLS = 16_000_000
DELTA_BITS, DELTA_ZERO = 10, 512

#: Symbols: bytes below 0xC0 as they are, lead bytes by class of their character.
LETTER, NUMBER, SPACE, OTHER = range(4)
N_SYMBOLS = 192 + 4 * 64


def _bytes_of_vocabulary() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the rest
    is numbered from U+0100."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(1)
def _classes() -> np.ndarray:
    """Class of every code point under the splitting pattern. The tokenizer
    library has its own version of Unicode: where the two tables at hand
    differ, it is asked how it splits the character."""
    out = np.full(0x110000, OTHER, np.uint8)
    old = out.copy()
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        out[[ord(c) for c in regex.findall(pattern, "".join(points))]] = kind
    kinds = {"L": LETTER, "N": NUMBER, "Z": SPACE}
    old[[ord(c) for c in points]] = [kinds.get(unicodedata.category(c)[0], OTHER) for c in points]
    old[[9, 10, 11, 12, 13, 0x85]] = SPACE
    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    for cp in np.flatnonzero(out != old).tolist():
        joined = [len(split(c + chr(cp))) == 1 for c in "a1!"]
        out[cp] = [LETTER, NUMBER, OTHER][joined.index(True)] if any(joined) else SPACE
    return out


class MergeMachine:
    """Merge states of one piece: ``step(state, byte) -> (state, change)``."""

    START = (b"", (), -1)

    def __init__(self, vocabulary: list[bytes], ranks: dict[tuple[bytes, bytes], int]):
        self.ranks = ranks
        self.ids = {t: i for i, t in enumerate(vocabulary)}
        self.vocabulary = vocabulary
        self.prefixes = {t[:i] for t in vocabulary for i in range(1, len(t) + 1)}
        self.growing = {t[:i] for t in vocabulary for i in range(1, len(t))}
        self.stable: dict[tuple[int, int], bool] = {}
        self.partners: dict[bytes, list[tuple[bytes, int]]] = {}
        for (a, b), rank in ranks.items():
            self.partners.setdefault(a, []).append((b, rank))
        self.spines: dict[bytes, list[tuple[bytes, int]]] = {}
        self.alike: dict[tuple[frozenset, bytes], int] = {}
        self.twins: dict[tuple[int, bytes], int] = {}

    def encode(self, word: bytes, until: int = 1) -> list[bytes]:
        parts = [word[i:i + 1] for i in range(len(word))]
        while len(parts) > until:
            best = min(range(len(parts) - 1), key=lambda i: self.ranks.get((parts[i], parts[i + 1]), 1 << 60))
            rank = self.ranks.get((parts[best], parts[best + 1]))
            if rank is None:
                break
            pair, merged, i = (parts[best], parts[best + 1]), [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    merged.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def follows(self, left: int, right: int) -> bool:
        """Whether the merges leave the two tokens side by side as they are."""
        key = (left, right)
        if (known := self.stable.get(key)) is None:
            a, b = (self.vocabulary[left] if left >= 0 else b""), self.vocabulary[right]
            known = self.stable[key] = self.encode(a + b) == ([a, b] if a else [b])
        return known

    def spine(self, token: bytes) -> list[tuple[bytes, int]]:
        """The parts at the token's right edge, from itself down to its last
        byte, each with the rank of the merge that uses it up."""
        if (known := self.spines.get(token)) is None:
            known = [(token, 1 << 60)]
            while len(part := known[-1][0]) > 1:
                left, right = self.encode(part, 2)
                known.append((right, self.ranks[(left, right)]))
            self.spines[token] = known
        return known

    def twin(self, token: int, begun: bytes) -> int:
        """A token that behaves like ``token`` before every token starting with
        ``begun``: the same merges across the border come before the ones
        inside it. States that differ only in such tokens are one state."""
        if token < 0:
            return token
        if (known := self.twins.get((token, begun))) is None:
            across = frozenset(
                (y, rank, rank == used) for x, used in self.spine(self.vocabulary[token])
                for y, rank in self.partners.get(x, ()) if rank <= used
                and (y.startswith(begun) or begun.startswith(y)))
            known = self.twins[(token, begun)] = self.alike.setdefault((across, begun), token) if across else -1
        return known

    def step(self, state: tuple, byte: int) -> tuple[tuple, int]:
        """State: (suffix, ((offset, last token, count relative to now)...), last token)."""
        suffix, marks, last = state
        grown = suffix + bytes((byte,))
        places = {o: (t, c) for o, t, c in marks}
        places[len(suffix)] = (last, 0)
        for offset in sorted(places):
            token = self.ids.get(grown[offset:])
            if token is not None and self.follows(places[offset][0], token):
                now, change = token, places[offset][1] + 1
                break
        else:
            raise ValueError("the vocabulary does not cover every byte")
        start = next((i for i in range(len(grown)) if grown[i:] in self.growing), len(grown))
        kept = tuple((o - start, self.twin(t, grown[o:]), c - change) for o, (t, c) in sorted(places.items())
                     if o >= start and grown[o:] in self.growing)
        return (grown[start:], kept, now), change

    def feed(self, state: tuple, data: bytes) -> tuple[tuple, int]:
        total = 0
        for byte in data:
            state, change = self.step(state, byte)
            total += change
        return state, total


class Transducer:
    """The pattern's modes around :class:`MergeMachine`, as one dense table.

    Fixed values of the pattern: an apostrophe form is ``'`` plus s, t, m, d,
    re, ve or ll. A machine state is a tuple whose first item is the mode:
    ``start``, ``run`` (class, merge state), ``quote`` (a lone apostrophe),
    ``half`` (apostrophe and r, v or l), ``closed`` (a finished form) and
    ``space`` (merge state before the held bytes, held bytes).
    """

    ENDS = {"r": "e", "v": "e", "l": "l"}

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = _bytes_of_vocabulary()
        special = [t["content"] for t in spec["added_tokens"]]
        plain = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        raw = {t: bytes(alphabet[c] for c in t) for t in plain}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.machine = MergeMachine([raw[t] for t in sorted(plain, key=plain.get)],
                                    {(raw[a], raw[b]): i for i, (a, b) in enumerate(pairs)})
        self.special = [s.encode() for s in special]
        self.classes = _classes()
        self.column = np.full(N_SYMBOLS, -1, np.int32)
        self.width, self.used = 64, 0
        self.symbols: list[int] = []
        self.clear()

    def clear(self) -> None:
        self.keys: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self.table = np.full(1024 * self.width, -1, np.int32)

    def state(self, key: tuple) -> int:
        got = self.ids.get(key)
        if got is None:
            got = self.ids[key] = len(self.keys)
            self.keys.append(key)
            if len(self.keys) * self.width > len(self.table):
                self.table = np.concatenate([self.table, np.full(len(self.table), -1, np.int32)])
        return got

    # -- one transition ----------------------------------------------------

    def _open(self, byte: int, kind: int) -> tuple[tuple, int]:
        m = self.machine
        if kind == SPACE:
            return ("space", m.START, bytes((byte,))), m.step(m.START, byte)[1]
        b, change = m.step(m.START, byte)
        return (("quote", b) if byte == 0x27 else ("run", kind, b)), change

    def advance(self, key: tuple, symbol: int) -> tuple[tuple, int]:
        m, mode = self.machine, key[0]
        if 128 <= symbol < 192:  # the rest of a character: its class is decided
            if mode == "run":
                b, change = m.step(key[2], symbol)
                return ("run", key[1], b), change
            if mode == "space":
                before, d0 = m.feed(key[1], key[2])
                return ("space", key[1], key[2] + bytes((symbol,))), m.step(before, symbol)[1]
            return self._open(symbol, OTHER)
        if symbol < 128:
            byte, kind = symbol, int(self.classes[symbol])
        else:
            kind, byte = divmod(symbol - 192, 64)
            byte += 0xC0
        if mode in ("start", "closed"):
            return self._open(byte, kind)
        if mode == "run":
            if kind == key[1] and kind != SPACE:
                b, change = m.step(key[2], byte)
                return ("run", kind, b), change
            return self._open(byte, kind)
        if mode == "quote":
            letter = chr(byte) if byte < 128 else ""
            if letter and letter in "stmd":
                return ("closed",), m.step(key[1], byte)[1]
            if kind == OTHER:
                b, change = m.step(key[1], byte)
                return ("run", OTHER, b), change
            if letter and letter in "rvl":
                b, change = m.step(m.START, byte)
                return ("half", letter, b), change
            return self._open(byte, kind)
        if mode == "half":
            if byte == ord(self.ENDS[key[1]]):
                whole = m.feed(m.START, f"'{key[1]}{chr(byte)}".encode())[1]
                apart = m.feed(m.START, b"'")[1] + m.feed(m.START, key[1].encode())[1]
                return ("closed",), whole - apart
            if kind == LETTER:
                b, change = m.step(key[2], byte)
                return ("run", LETTER, b), change
            return self._open(byte, kind)
        before, held = key[1], key[2]
        after, own = m.feed(before, held)
        if kind == SPACE:
            return ("space", after, bytes((byte,))), m.step(after, byte)[1]
        if held == b" ":
            b, change = m.feed(m.START, held + bytes((byte,)))
            return ("run", kind, b), change - own
        opened, change = self._open(byte, kind)
        return opened, m.feed(m.START, held)[1] + change - own

    # -- lockstep runs -----------------------------------------------------

    def symbols_of(self, raw: np.ndarray) -> np.ndarray:
        """Table column of every byte."""
        out = raw.astype(np.int32)
        lead = np.flatnonzero(raw >= 0xC0)
        if len(lead):
            b = np.concatenate([raw, np.zeros(4, np.uint8)]).astype(np.int64)
            b0, b1, b2, b3 = (b[lead + i] for i in range(4))
            cp = np.where(b0 < 0xE0, (b0 & 31) << 6 | b1 & 63,
                          np.where(b0 < 0xF0, (b0 & 15) << 12 | (b1 & 63) << 6 | b2 & 63,
                                   (b0 & 7) << 18 | (b1 & 63) << 12 | (b2 & 63) << 6 | b3 & 63))
            out[lead] = 192 + 64 * self.classes[np.minimum(cp, 0x10FFFF)].astype(np.int32) + (b0 - 0xC0)
        met = np.flatnonzero(np.bincount(out, minlength=N_SYMBOLS))
        for s in met[self.column[met] < 0].tolist():
            self.column[s] = len(self.symbols)
            self.symbols.append(s)
        if len(self.symbols) > self.width:
            old, rows = self.width, len(self.table) // self.width
            self.width = 1 << (len(self.symbols) - 1).bit_length()
            table = np.full((rows, self.width), -1, np.int32)
            table[:, :old] = self.table.reshape(rows, old)
            self.table = table.ravel()
        return self.column[out]

    def _fill(self, cells: np.ndarray) -> None:
        for cell in np.unique(cells).tolist():
            state, column = divmod(cell, self.width)
            to, change = self.advance(self.keys[state], self.symbols[column])
            self.table[cell] = -2  # the table may move below
            packed = (self.state(to) << DELTA_BITS) + change + DELTA_ZERO
            self.table[cell] = packed

    def run(self, columns: np.ndarray, starts: np.ndarray, ends: np.ndarray,
            states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end state, count change) of each lane over columns[start:end]."""
        lengths = ends - starts
        order = np.argsort(-lengths, kind="stable")
        at, length = starts[order].copy(), lengths[order]
        state, count = states[order].astype(np.int64), np.zeros(len(order), np.int64)
        alive = len(order) - np.searchsorted(length[::-1], np.arange(1, (length[0] if len(length) else 0) + 1))
        for n in alive.tolist():
            if len(self.keys) * self.width > MAX_CELLS:
                state = self._renumber(state)
            cells = state[:n] * self.width + columns[at[:n]]
            packed = self.table[cells]
            if packed.min() < 0:
                self._fill(cells[packed < 0])
                packed = self.table[cells]
            state[:n] = packed >> DELTA_BITS
            count[:n] += packed & ((1 << DELTA_BITS) - 1)
            at[:n] += 1
        count -= length * DELTA_ZERO
        out_state, out_count = np.empty_like(state), np.empty_like(count)
        out_state[order], out_count[order] = state, count
        return out_state, out_count

    def _renumber(self, state: np.ndarray) -> np.ndarray:
        """Start the table afresh with the states in use."""
        used, place = np.unique(state, return_inverse=True)
        keys = [self.keys[i] for i in used.tolist()]
        self.clear()
        return np.array([self.state(k) for k in keys], np.int64)[place]

    # -- texts -------------------------------------------------------------

    def segments(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text) of the stretches between special strings, and
        the number of special tokens of each text."""
        n = len(offsets) - 1
        extra, whole = np.zeros(n, np.int64), raw.tobytes()
        if not any(s in whole for s in self.special):
            return offsets[:-1], offsets[1:], np.arange(n), extra
        out = []
        for i in range(n):
            at, end = int(offsets[i]), int(offsets[i + 1])
            while True:
                hits = [(p, -len(s)) for s in self.special if (p := whole.find(s, at, end)) >= 0]
                if not hits:
                    break
                p, size = min(hits)
                out.append((at, p, i))
                extra[i] += 1
                at = p - size
            out.append((at, end, i))
        a = np.array(out, np.int64).reshape(-1, 3)
        return a[:, 0], a[:, 1], a[:, 2], extra

    def count(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text raw[offsets[i]:offsets[i + 1]]."""
        starts, ends, text, total = self.segments(raw, offsets)
        keep = ends > starts
        starts, ends, text = starts[keep], ends[keep], text[keep]
        if not len(starts):
            return total
        if len(self.keys) * self.width > MAX_CELLS:
            self.clear()
        columns = self.symbols_of(raw)
        maps = ChunkMaps(raw, starts, ends, CHUNK)
        begin = self.state(("start",))
        after_space = np.full(256, -1, np.int64)
        for b in np.unique(raw[maps.sync[maps.sync >= 0]]).tolist():
            after_space[b] = self.state(("space", self.machine.START, bytes((b,))))
        fresh = np.where(maps.first, begin, after_space[raw[np.maximum(maps.sync, 0)]])
        known = maps.first | (maps.sync >= 0)
        # Every run may renumber the states, so what outlives one is kept by key.
        tails = np.where(maps.first, maps.start, maps.sync + 1)
        state, change = self.run(columns, tails[known], maps.end[known], fresh[known])
        count = np.zeros(len(maps.start), np.int64)
        count[known] += change
        exits = np.full(len(maps.start), -1, np.int64)
        exits[known] = state
        heads = maps.heads(maps.scan())
        if len(heads):
            lane, source, a, b = heads.T
            count[lane] += self.run(columns, a, b, exits[source])[1]
        np.add.at(total, text[maps.segment], count)
        return total


class ChunkMaps:
    """Chunks of all segments and the shape of their state maps.

    Chunk j of a segment maps an entry state to (exit state, count). If the
    chunk is the first, or has a synchronising white space, the exit does not
    depend on the entry and only the count of the head does. ``scan`` composes
    neighbouring maps by doubling; composing an open map with its successor
    extends the successor's head to the left.
    """

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int):
        per = -(-(ends - starts) // size)
        self.segment = np.repeat(np.arange(len(starts)), per)
        number = np.arange(len(self.segment)) - np.repeat(np.cumsum(per) - per, per)
        self.start = starts[self.segment] + number * size
        self.end = np.minimum(self.start + size, ends[self.segment])
        self.first, self.number = number == 0, number
        blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
        solid = (raw < 128) & ~blank
        marks = np.flatnonzero(blank[1:] & solid[:-1]) + 1
        after = np.searchsorted(marks, self.start + 1)
        mark = np.append(marks, len(raw))[after]
        self.sync = np.where((mark < self.end) & ~self.first, mark, -1)

    def scan(self) -> np.ndarray:
        """For each chunk the nearest chunk before it, in its segment, whose
        exit does not depend on its entry (inclusive prefix by doubling)."""
        index = np.arange(len(self.start))
        fixed = self.first | (self.sync >= 0)
        nearest = np.where(fixed, index, -1)
        hop, longest = 1, int(self.number.max(initial=0)) + 1
        while hop < longest and (nearest < 0).any():
            open_ = np.flatnonzero((nearest < 0) & (self.number >= hop))
            nearest[open_] = nearest[open_ - hop]
            hop *= 2
        return nearest

    def heads(self, nearest: np.ndarray) -> np.ndarray:
        """(chunk, chunk to enter from, from, to) of all stretches whose count
        depends on an entry state: heads with the open chunks before them, and
        open chunks that end their segment."""
        n = len(self.start)
        index = np.arange(n)
        last = np.append(self.first[1:], True)
        synced = np.flatnonzero(self.sync >= 0)
        closing = np.flatnonzero((self.sync < 0) & ~self.first & last)
        chunk = np.concatenate([index[synced], index[closing]])
        source = np.concatenate([nearest[synced - 1], nearest[closing]])
        to = np.concatenate([self.sync[synced] + 1, self.end[closing]])
        return np.stack([chunk, source, self.end[source], to], 1) if len(chunk) else np.zeros((0, 4), np.int64)


@lru_cache(2)
def transducer(path: str) -> Transducer:
    """One per worker process and tokenizer file."""
    return Transducer(path)


def count_tokens(texts: pa.Array, path: str) -> np.ndarray:
    machine, out = transducer(path), np.zeros(len(texts), np.int64)
    for a, b, raw, offsets in slices(texts):
        out[a:b] = machine.count(raw, offsets)
    return out


def n_tokens(text: Column | str, path: str) -> Column:
    """Number of tokens of a text column under the tokenizer file ``path``
    (byte-level BPE ``.json``), without added begin or end tokens."""
    @arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        return pa.array(count_tokens(texts, path), pa.int64())

    return counted(F.col(text) if isinstance(text, str) else text)


def token_counts(docs: DataFrame, path: str, limit: int = 512, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > limit)."""
    return (docs.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
            .withColumn("n_tokens", n_tokens(text, path))
            .withColumn("over_limit", F.col("n_tokens") > limit))
