"""Packing documents into sequences of bounded length by order-preserving dynamic programming.

A task lays its documents' tokens end to end. Windows may be cut behind a document (free), behind a sentence
(a penalty) and, where neither comes within a window's length, anywhere (a larger one). With G(j) the least cost of
cutting at boundary j, measured so that padding is included, G(j) = penalty(j) + length + min G(i) over the
boundaries i at most `length` tokens before j: a sliding minimum, which a monotone queue keeps in linear time.
"""

from __future__ import annotations

import os
import unicodedata
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termsieve.llm import text as T
from termsieve.llm.runtime import ship, tidied

#: Pieces that a worker remembers with their ids, in about 40 bytes each; the half unused for longest is forgotten beyond.
REMEMBERED = 1 << 20


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass(frozen=True)
class Settings:
    """length: tokens of a sequence. end: id behind every document. Penalties are in tokens of padding."""

    tokenizer: str | None = None
    length: int = 4096
    end: int = 2
    sentence: float = 8.0
    anywhere: float = 64.0


#: Byte values of the second hash of a long word.
OTHER = T.mix(T.BYTE) | T.U64(1)
#: The tokenizer's own pre-tokens: contractions, runs of letters, single digits, runs of anything else.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Kinds of bytes. A word with an odd one isn't cut into pieces here: apostrophes, controls, and characters from U+0080
#: on but for the letters from U+00C0 to U+00FF, which all begin with LATIN.
BLANK, LETTER, MARK, DIGIT, ODD, LATIN = 0, 1, 2, 3, 4, 0xC3


def _kinds() -> np.ndarray:
    """The kind of each byte; the second byte of a character goes by its first."""
    kinds = np.full(256, ODD, np.uint8)
    for b in range(33, 127):
        kinds[b] = LETTER if chr(b).isalpha() else DIGIT if chr(b).isdigit() else MARK
    kinds[ord("'")], kinds[LATIN], kinds[T.SPACE] = ODD, LETTER, BLANK
    return kinds


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: printable Latin-1 for itself, others from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices of stretches in a row."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class Memory:
    """Token ids of pieces by two 64-bit numbers, in flat arrays behind a table of slots that is at most half full."""

    def __init__(self, limit: int, kind: type) -> None:
        self.limit, self.now, self.count, self.filled = limit, 0, 0, 0
        self.one, self.two = np.empty(0, T.U64), np.empty(0, T.U64)
        self.starts, self.used = np.zeros(1, np.int32), np.empty(0, np.int32)
        self.pool = np.empty(0, kind)
        self._deal(1 << 12)

    def _deal(self, slots: int) -> None:
        """A table of so many slots, a power of two, for what is there."""
        self.slots, self.shift = np.full(slots, -1, np.int32), T.U64(65 - slots.bit_length())
        self._place(np.arange(self.count, dtype=np.int32))

    def _slot(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return (T.mix(one * T.BASE + two) >> self.shift).astype(np.int64)

    def _place(self, new: np.ndarray) -> None:
        """Puts places into the first free slots from their own on."""
        slot = self._slot(self.one[new], self.two[new])
        while len(new):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = new[free]
            left = self.slots[slot] != new
            new, slot = new[left], (slot[left] + 1) & (len(self.slots) - 1)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The places of pieces, -1 for those that are not there."""
        slot = self._slot(one, two)
        place = self.slots[slot]
        open_ = np.flatnonzero((place >= 0) & ((self.one[place] != one) | (self.two[place] != two))) if self.count else []
        slot = slot[open_]
        while len(open_):
            slot = (slot + 1) & (len(self.slots) - 1)
            place[open_] = own = self.slots[slot]
            more = (own >= 0) & ((self.one[own] != one[open_]) | (self.two[own] != two[open_]))
            open_, slot = open_[more], slot[more]
        self.used[place[place >= 0]] = self.now
        return place

    def add(self, one: np.ndarray, two: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Remembers distinct pieces that are not there, with their ids in a row."""
        count, filled = self.count + len(one), self.filled + len(ids)
        for name, least in (("one", count), ("two", count), ("used", count), ("starts", count + 1), ("pool", filled)):
            self._grow(name, least)
        new = slice(self.count, count)
        self.one[new], self.two[new], self.used[new] = one, two, self.now
        self.starts[self.count + 1 : count + 1] = np.cumsum(sizes) + self.filled
        self.pool[self.filled : filled] = ids
        places = np.arange(self.count, count, dtype=np.int32)
        self.count, self.filled = count, filled
        if 2 * count > len(self.slots):
            self._deal(1 << (2 * count - 1).bit_length())
        else:
            self._place(places)

    def _grow(self, name: str, least: int) -> None:
        old = getattr(self, name)
        if least > len(old):
            grown = np.empty(max(least, len(old) + len(old) // 4), old.dtype)
            grown[: len(old)] = old
            setattr(self, name, grown)

    def forget(self, room: int) -> bool:
        """Where so many pieces more would pass the limit, keeps the half used last; whether it did."""
        if not self.count or not room or self.count + room <= self.limit:
            return False
        used = self.used[: self.count]
        keep = np.flatnonzero(used > np.median(used))
        sizes = self.starts[keep + 1] - self.starts[keep]
        self.pool = self.pool[_spread(self.starts[keep], sizes)]
        for name in ("one", "two", "used"):
            setattr(self, name, getattr(self, name)[keep])
        self.starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        self.count, self.filled = len(keep), len(self.pool)
        self._deal(len(self.slots))
        return True

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces by their places, in a row, and where each one's ids end."""
        starts = self.starts[places]
        sizes = self.starts[places + 1] - starts
        return self.pool[_spread(starts, sizes)].astype("<u4"), np.cumsum(sizes)


class Encoder:
    """Token ids of whole texts, through memory of the pieces seen so far.

    The tokenizer composes and lower-cases, splits into pieces that never reach across white space, and encodes each
    piece by itself with one word-end token, its last; so the ids of a text are those of its pieces in a row. The
    pieces of a block of texts are cut at once where bytes tell how, and looked up. Words whose pieces other rules
    decide are looked up whole. Those that are new are encoded, many at once, by the tokenizer's model alone, or by
    all of it where its other steps would change them.
    """

    #: Pieces encoded in one call.
    MANY = 4000

    def __init__(self, file: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(file)
        self.whole.encode_special_tokens = True
        self.model = Tokenizer(self.whole.model)  # shared, not copied
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = _byte_letters()
        self.pieces = regex.compile(PIECES).findall
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.stops = self.ends.copy()
        for token, i in vocabulary.items():
            if token.endswith("</w>"):
                self.ends[i] = True
                self.stops[i] = len(token) > 4 and set(token[:-4]) <= set(".!?")
        self.memory = Memory(REMEMBERED, np.uint16 if len(self.ends) <= 1 << 16 else np.uint32)
        self.kinds, self.lower = _kinds(), np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.doubled = np.array([list(self.letters[max(b, 128)].encode()) for b in range(256)], np.uint8)
        self.masks = np.array([(1 << 8 * n) - 1 for n in range(9)], T.U64)

    def _ids(self, text: str) -> bytes:
        """The ids of a text by the whole tokenizer, which few words need."""
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _joined_ids(self, joined: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces in the vocabulary's letters with a space between, and where each one's ids end."""
        ids = np.array(self.model.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
        return ids, np.flatnonzero(self.ends[ids]) + 1

    def _piece_ids(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece: lower-case, composed and without white space, encoded many at once."""
        out: list[bytes] = []
        for i in range(0, len(pieces), self.MANY):
            part = pieces[i : i + self.MANY]
            joined = " ".join(part)
            if not joined.isascii():
                joined = " ".join([p if p.isascii() else p.encode().decode("latin-1").translate(self.letters) for p in part])
            ids, last = self._joined_ids(joined)
            if len(last) != len(part):  # some piece isn't one to the tokenizer
                out += [self._ids(r) for r in part]
                continue
            raw, first = ids.tobytes(), 0
            for stop in (last * 4).tolist():
                out.append(raw[first:stop])
                first = stop
        return out

    def _split(self, word: str) -> list[str] | None:
        """The pieces of a word as the tokenizer sees them; None where its rules need the word as it is."""
        if word.isascii():
            return self.pieces(word.lower()) if word.isprintable() else None
        if not word.isprintable() or "\u03a3" in word or not unicodedata.is_normalized("NFC", word):
            return None
        low = word.lower()
        return [low] if word.isalpha() and low.isalpha() else self.pieces(low)

    def _learned(self, fresh: list[str]) -> list[bytes]:
        """The ids of words."""
        parts = [self._split(w) for w in fresh]
        pieces = list({p for x in parts if x for p in x})
        known = dict(zip(pieces, self._piece_ids(pieces), strict=True))
        return [self._ids(w) if x is None else known[x[0]] if len(x) == 1 else b"".join([known[p] for p in x]) for w, x in zip(fresh, parts, strict=True)]

    def _plain(self, low: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The numbers of ids of pieces that bytes tell, and their ids in a row, both in parts."""
        counts, found = [], []
        for i in range(0, len(starts), self.MANY):
            first, size = starts[i : i + self.MANY], sizes[i : i + self.MANY]
            data = low[_spread(first, size + 1)]  # each with the byte behind it
            data[np.cumsum(size + 1) - 1] = 32
            high = data > 127
            if high.any():  # two bytes for each
                at = np.flatnonzero(high)
                data = np.repeat(data, 1 + high)
                at += np.arange(len(at))
                data[at], data[at + 1] = self.doubled[data[at]].T
            ids, last = self._joined_ids(data.tobytes().decode())
            if len(last) != len(first):  # some piece isn't one to the tokenizer
                each = [np.frombuffer(self._ids(low[a : a + n].tobytes().decode()), "<u4") for a, n in zip(first.tolist(), size.tolist(), strict=True)]
                ids, last = np.concatenate(each), np.cumsum([len(x) for x in each])
            counts.append(np.diff(last, prepend=0))
            found.append(ids)
        return counts, found

    def _cut(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The bytes, in lower case but for odd words, start and size of every piece or odd word, and whether it is odd."""
        kinds, low = self.kinds[data], self.lower[data]
        latin = np.flatnonzero(data == LATIN) + 1
        if len(latin):
            second = data[latin]
            letter = (second != 0x97) & (second != 0xB7)  # the signs of multiplication and division
            kinds[latin] = np.where(letter, LETTER, ODD)
            low[latin] = np.where(letter & (second < 0x9F), second + 32, second)
        odd = np.flatnonzero(kinds == ODD)
        if len(odd):  # their case, composition and pieces depend on more than single bytes
            begin, end = T.runs(data)
            word = np.searchsorted(begin, odd, "right") - 1
            word = word[np.diff(word, prepend=-1) > 0]
            inside = _spread(begin[word], end[word] - begin[word])
            kinds[inside], low[inside] = ODD, data[inside]
        edge = kinds[1:] != kinds[:-1]
        edge |= kinds[1:] == DIGIT
        edges = np.concatenate(([0], np.flatnonzero(edge) + 1, [len(data)]))
        kind = kinds[edges[:-1]]
        kept = np.flatnonzero(kind != BLANK)
        starts = edges[kept]
        return low, starts, edges[kept + 1] - starts, kind[kept] == ODD

    def _numbers(self, low: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit numbers for each span of bytes: up to 15 bytes and their number, or else 120 bits of hashes."""
        eights = np.ndarray(len(low) + 8, "<u8", np.concatenate((low, np.zeros(16, np.uint8))), strides=(1,))
        one = eights[starts] & self.masks[np.minimum(sizes, 8)]
        two = sizes.astype(T.U64) << T.U64(56)
        more = np.flatnonzero(sizes > 8)
        two[more] |= eights[starts[more] + 8] & self.masks[np.minimum(sizes[more] - 8, 7)]
        long = np.flatnonzero(sizes > 15)
        if len(long):
            size = sizes[long]
            part, ends = low[_spread(starts[long], size)], np.cumsum(size)
            one[long] = T.span_hashes(part, ends - size, ends, T.BYTE)
            two[long] = T.span_hashes(part, ends - size, ends, OTHER) | T.U64(255 << 56)
        return one, two

    def block(self, raw: list[bytes]) -> list[np.ndarray]:
        """The ids of each text of a block."""
        data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        low, starts, sizes, odd = self._cut(data)
        one, two = self._numbers(low, starts, sizes)
        memory = self.memory
        memory.now += 1
        place = memory.find(one, two)
        fresh = np.flatnonzero(place < 0)
        if memory.forget(len(fresh)):
            place = memory.find(one, two)
            fresh = np.flatnonzero(place < 0)
        if len(fresh):
            order = fresh[np.lexsort((two[fresh], one[fresh]))]
            first = np.ones(len(order), bool)
            first[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
            new = order[first]
            plain, words = new[~odd[new]], new[odd[new]]
            counts, ids = self._plain(low, starts[plain], sizes[plain])
            if len(words):
                text = low.tobytes()
                found = self._learned([text[a : a + n].decode() for a, n in zip(starts[words].tolist(), sizes[words].tolist(), strict=True)])
                counts.append(np.fromiter(map(len, found), np.int64, len(found)) // 4)
                ids.append(np.frombuffer(b"".join(found), "<u4"))
            new = np.concatenate((plain, words))
            memory.add(one[new], two[new], np.concatenate(counts), np.concatenate(ids))
            place[fresh] = memory.find(one[fresh], two[fresh])
        ids, stops = memory.ids(place)
        at = np.searchsorted(starts, np.concatenate(([0], np.cumsum([len(r) + 1 for r in raw]))))
        bounds = np.concatenate(([0], stops))[at]
        return [ids[a:z] for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text, in order."""
        for raw in T.batches(T.utf8(column)):
            if len(raw) > 1 or len(raw[0]) <= T.BLOCK:
                yield from self.block(raw)
            else:
                yield np.concatenate([ids for part in T.segments(raw[0]) for ids in self.block([part])])


def cuts(ends: list[int], costs: list[float], length: int) -> list[int]:
    """Indices of the boundaries to cut at, the last one always: least padding plus penalties.

    ends: increasing token counts at the boundaries, no two further apart than `length`, the first at most `length`.
    The last window is not padded: it stays open, or is cut into powers of two.
    """
    best: list[float] = [0.0]
    at = [0, *ends]
    came = [0] * len(at)
    queue: deque[int] = deque([0])
    for j in range(1, len(at)):
        low = at[j] - length
        while at[queue[0]] < low:
            queue.popleft()
        i = queue[0]
        g = best[i] + costs[j - 1] + length
        best.append(g)
        came[j] = i
        while queue and best[queue[-1]] >= g:
            queue.pop()
        queue.append(j)
    j = len(at) - 1
    came[j] = min((i for i in range(bisect_left(at, at[j] - length), j)), key=lambda i: best[i] - at[i])
    out = []
    while j:
        out.append(j - 1)
        j = came[j]
    return out[::-1]


def boundaries(ids: np.ndarray, last: np.ndarray, stops: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Token counts and penalties of the places where a window may end. last: counts at the ends of documents."""
    mark, soft = stops[ids], np.zeros(len(ids), bool)
    soft[last - 1] = mark[last - 1] = True
    mark[-1] = True
    at = np.flatnonzero(mark) + 1
    gaps = np.diff(at, prepend=0)
    far = np.flatnonzero(gaps > s.length)
    if len(far):
        step = max(1, s.length // 16)
        at = np.union1d(at, np.concatenate([np.arange(at[k] - gaps[k] + step, at[k], step) for k in far]))
    return at, np.where(soft[at - 1], 0.0, np.where(stops[ids[at - 1]], s.sentence, s.anywhere))


#: Tokens that a task lays out at once.
LAYOUT = 1 << 18
_OUT = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class _Layout:
    """The documents of a task that are not in finished sequences yet."""

    def __init__(self, s: Settings, stops: np.ndarray, task: int) -> None:
        self.s, self.stops = s, stops
        self.sequence = task << 40
        self.docs: list[tuple[int | None, int, np.ndarray, int]] = []  # id, start, a stretch of its ids, tokens of the whole
        self.tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Takes a document, a stretch at a time, and gives the sequences that are finished then."""
        for start in range(0, len(ids), LAYOUT):
            part = ids[start : start + LAYOUT]
            self.docs.append((doc_id, start, part, len(ids)))
            self.tokens += len(part)
            if self.tokens >= LAYOUT and (out := self.flush(False)) is not None:
                yield out

    def flush(self, final: bool) -> pa.RecordBatch | None:
        """Cuts what is there into sequences; but for the final call, the last one stays open."""
        if not self.docs:
            return None
        ids = np.concatenate([d[2] for d in self.docs])
        ends = np.cumsum([len(own) for _, _, own, _ in self.docs])
        whole = np.array([start + len(own) == n for _, start, own, n in self.docs])
        at, cost = boundaries(ids, ends[whole], self.stops, self.s)
        marks = [int(at[j]) for j in cuts(at.tolist(), cost.tolist(), self.s.length)]
        if not final:
            marks.pop()
        elif (rest := marks[-1] - (marks[-2] if len(marks) > 1 else 0)) < self.s.length:
            base = marks.pop() - rest  # powers of two need no padding
            for bit in range(rest.bit_length() - 1, -1, -1):
                if rest >> bit & 1:
                    base += 1 << bit
                    marks.append(base)
        rows: list[tuple] = []
        left: list[tuple[int | None, int, np.ndarray, int]] = []
        k, begin, place = 0, 0, 0
        for doc_id, start, own, whole in self.docs:
            done = 0
            while done < len(own) and k < len(marks):
                take = min(len(own) - done, marks[k] - place)
                rows.append((doc_id, start + done, take, own[done : done + take].tobytes(), whole, self.sequence + k, place - begin))
                done += take
                place += take
                if place == marks[k]:
                    begin = place
                    k += 1
            if done < len(own):
                left.append((doc_id, start + done, own[done:], whole))
        self.sequence += len(marks)
        self.docs = left
        self.tokens = sum(len(d[2]) for d in left)
        if not rows:
            return None
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


_encoders: dict[str, Encoder] = {}


def _pack(s: Settings):
    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = s.tokenizer or tokenizer_file()
        if file not in _encoders:
            _encoders[file] = Encoder(file)
        encoder = _encoders[file]
        context = TaskContext.get()
        layout = _Layout(s, encoder.stops, context.partitionId() if context else 0)
        end = np.array([s.end], "<u4")
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.texts(batch.column(1)), strict=True):
                yield from layout.add(doc_id, np.concatenate((ids, end)))
            del batch  # before the next one comes
        if (out := layout.flush(True)) is not None:
            yield out

    return run


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings | None = None) -> DataFrame:
    """One row per piece: id_col, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset.

    Documents keep the order in which a task reads them; every token, the end id included, lies in one piece, and
    the pieces of a sequence fill it without gaps from offset 0. A task's last sequence is cut into powers of two.
    Null and empty texts are documents of the end id alone. Repeated rows and null ids are packed like others.
    Nothing is shuffled: a task packs the input partition that it reads, and its number is part of sequence_id.
    """
    ship(docs.sparkSession)
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(_pack(settings or Settings()), _OUT).withColumnRenamed("doc_id", id_col)


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
