"""Exact removal of repeated byte strings with suffix arrays built by external induced sorting.

1. Exact copies of a document are found by digest.
2. Every 50-byte string is owned by the smallest hashed 16-gram in it (its anchor), the leftmost if it
   occurs there again, which depends on its bytes alone. A document's neighbouring strings with one
   anchor form a context, a short run of bytes. Contexts meet by anchor, as hashes. Of equal contexts all but the smallest document's are
   removed whole.
3. Where an anchor has several different contexts, those of the smallest documents go to a shard as
   bytes. A shard sorts its suffixes by induced sorting: the leftmost S-type suffixes are sorted
   bucket by bucket, and disk-backed queues, keyed by first byte, induce the L-type suffixes from them
   in rising and the S-type suffixes in falling order. Neighbours that share 50 bytes form the groups
   in which the smallest document keeps its string.

Only the first 50 bytes of a suffix matter here, so the S-type seeds are sorted to that depth
directly instead of by recursion on their names; and equality of neighbours is read off the text.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdex.llm.common import stored
from verdex.llm.shingles import mixed

GRAM = 16
#: Bytes of text handled at once.
PIECE = 1 << 18
#: Bytes of queue entries that a shard holds in memory before it writes them to disk.
HELD = 48 << 20
#: Up to so many document keys are broadcast; more are joined by shuffle.
BROADCAST_KEYS = 500_000
#: Bits of an anchor that travel. Unlike anchors that agree in them meet needlessly, nothing else.
ANCHOR_BITS = 48
#: A place is a text's shift plus a position in it, which takes so many bits; what lies above them
#: tells the texts of one id apart.
PLACE_BITS = 31
#: Strings of a context at most; where one gram occurs again and again, as in a rule of dashes, it
#: would otherwise go on.
RUN = 64
#: Added to the sides of a context in which the anchor occurs at several places.
TIED = 1 << 16

_TOP = np.iinfo(np.int64).max
_BASE = 0x9E3779B97F4A7C15 | 1


# Anchors ------------------------------------------------------------------------------------------


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hash of each 16-gram of a byte array."""
    w = b.astype(np.uint64)
    for k in (1, 2, 4):
        w = w[: len(w) - k] | (w[k:] << np.uint64(8 * k))  # in the end eight bytes
    n = len(b) - GRAM + 1
    x = w[:n] * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return mixed(x + w[GRAM - 8 : GRAM - 8 + n])


class Contexts:
    """Contexts of byte strings: runs of at most `RUN` starts of `length`-byte strings with one anchor."""

    def __init__(self, length: int) -> None:
        self.length, self.side = length, (length - GRAM) // 2
        most = PIECE + length + 1
        # powers of an odd number and of its inverse, modulo 2**64, and a number for each byte
        self.power, self.inverse = np.ones(most, dtype=np.uint64), np.ones(most, dtype=np.uint64)
        self.power[1:], self.inverse[1:] = _BASE, pow(_BASE, -1, 2**64)
        self.power, self.inverse = np.cumprod(self.power), np.cumprod(self.inverse)
        self.byte = mixed(np.arange(1, 257, dtype=np.uint64))

    def of(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Contexts in the concatenation `data` of texts with these `ends`: number of the text, start,
        size, anchor, sides and hash.

        A string that holds an anchor also holds the `side` bytes before it or those after it.
        `sides` has 8 bits of a hash of either, 0 where the text has no such bytes; `TIED` is added where
        the anchor occurs at several places of the context, so that the sides of one do not tell.
        """
        length, span = self.length, self.length - GRAM + 1
        h = _gram_hashes(data)
        # the low bits count from the string's start, so of equal grams the leftmost is taken
        m, size = h & ~np.uint64(63), 1
        while 2 * size <= span:
            m = np.minimum(m[: len(m) - size], m[size:] + np.uint64(size))
            size *= 2
        if size < span:
            m = np.minimum(m[: len(m) - (span - size)], m[span - size :] + np.uint64(span - size))
        own = np.arange(len(m)) + (m & np.uint64(63)).astype(np.int64)
        anchor = h[own] >> np.uint64(64 - ANCHOR_BITS)
        # the strings that begin in the last bytes of a text would cross its end
        inside = np.ones(len(m) + length, dtype=bool)
        for back in range(1, length):
            inside[np.maximum(ends - back, 0)] = False
        inside = inside[: len(m)]
        begins = np.concatenate(([0], ends[:-1]))
        short = ends - begins < length
        for a, b in zip(begins[short].tolist(), ends[short].tolist()):
            inside[a:b] = False
        fresh = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | ~inside[:-1])) & inside
        place = np.arange(len(m))
        fresh |= ((place - np.maximum.accumulate(np.where(fresh, place, 0))) % RUN == 0) & inside
        over = np.concatenate((fresh[1:] | ~inside[1:], [True])) & inside
        first, last = np.flatnonzero(fresh), np.flatnonzero(over)
        total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(self.byte[data] * self.power[: len(data)])))
        size, at = last - first + length, own[first]
        tied = np.where(own[last] > at, np.uint64(TIED), np.uint64(0))
        which = np.searchsorted(ends, first, side="right")

        def value(a: np.ndarray, n: np.ndarray | int) -> np.ndarray:
            return mixed((total[a + n] - total[a]) * self.inverse[a] + np.asarray(n).astype(np.uint64))

        def short_value(a: np.ndarray, present: np.ndarray) -> np.ndarray:
            return np.where(present, value(np.where(present, a, 0), self.side) % np.uint64(255) + np.uint64(1), np.uint64(0))

        before = short_value(at - self.side, at - self.side >= begins[which])
        after = short_value(at + GRAM, at + GRAM + self.side <= ends[which])
        sides = before * np.uint64(256) + after + tied
        return which, first, size, anchor[first].view(np.int64), sides.view(np.int64), value(first, size).view(np.int64)

    def batches(self, texts: Iterator[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
        """All contexts of texts, some texts or a piece of a long one at a time: number of the text,
        start in it, size, anchor, sides, hash."""
        held, numbers, shifts, total = [], [], [], 0

        def found() -> Iterator[tuple[np.ndarray, ...]]:
            if total < self.length:
                return
            ends = np.cumsum([len(x) for x in held])
            which, start, *rest = self.of(np.frombuffer(b"".join(held), dtype=np.uint8), ends)
            begins = ends - [len(x) for x in held]
            yield np.array(numbers)[which], start - begins[which] + np.array(shifts)[which], *rest

        for number, text in enumerate(texts):
            # neighbouring pieces of a long text share length - 1 bytes, so each string is in one
            for at in range(0, max(1, len(text) - self.length + 1), PIECE - self.length + 1):
                piece = text[at : at + PIECE]
                if total + len(piece) > PIECE:
                    yield from found()
                    held, numbers, shifts, total = [], [], [], 0
                held.append(piece)
                numbers.append(number)
                shifts.append(at)
                total += len(piece)
        if held:
            yield from found()


# Induced sorting ----------------------------------------------------------------------------------


class Queue:
    """A queue of suffix positions keyed by first byte, kept on disk beyond `HELD` bytes.

    In induced sorting the positions of one key arrive in their final order, so a key's entries
    need no further sorting.
    """

    def __init__(self, folder: Path, held: int = HELD) -> None:
        # entries lie in memory or, beyond the bound, in one file per key
        self.folder, self.held, self.size, self.type = folder, held, 0, np.dtype(np.int64)
        self.parts: dict[int, list[np.ndarray]] = {}
        folder.mkdir()

    def push(self, keys: np.ndarray, positions: np.ndarray) -> None:
        if not len(keys):
            return
        order = np.argsort(keys, kind="stable")
        keys, positions = keys[order], positions[order]
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for key, part in zip(keys[np.concatenate(([0], cuts))].tolist(), np.split(positions, cuts)):
            self.put(key, part)

    def put(self, key: int, positions: np.ndarray) -> None:
        """Entries of one key."""
        self.type = positions.dtype
        self.parts.setdefault(key, []).append(positions)
        self.size += positions.nbytes
        if self.size > self.held:
            for key, parts in self.parts.items():
                with (self.folder / str(key)).open("ab") as f:
                    np.concatenate(parts).tofile(f)
            self.parts, self.size = {}, 0

    def take(self, key: int) -> np.ndarray:
        """All entries of `key` so far, in order of arrival; they leave the queue."""
        file, parts = self.folder / str(key), self.parts.pop(key, [])
        self.size -= sum(p.nbytes for p in parts)
        if file.exists():
            parts.insert(0, np.fromfile(file, dtype=self.type))
            file.unlink()
        return np.concatenate(parts) if parts else np.zeros(0, dtype=self.type)


def _s_type(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; from the end, block by block."""
    out = np.zeros(len(t), dtype=bool)
    for begin in range((len(t) - 1) // PIECE * PIECE, -1, -PIECE):
        part = t[begin : begin + PIECE + 1].astype(np.int16)
        last = begin + PIECE >= len(t)
        step = np.sign(np.diff(part, append=[-1] if last else []))
        # an equal pair is decided by the next unequal one, beyond the block by what follows it
        index = np.where(step != 0, np.arange(len(step)), len(step))
        following = np.minimum.accumulate(index[::-1])[::-1]
        beyond = 1 if not last and out[begin + PIECE] else -1
        out[begin : begin + len(step)] = np.append(step, beyond)[following] > 0
    return out


def suffix_order(t: np.ndarray, words: np.ndarray, depth: int, folder: Path, held: int = HELD) -> Iterator[np.ndarray]:
    """Positions of byte array `t` by their suffixes' first `depth` bytes, an array per first byte.

    `words[i]` holds the eight bytes from i on as a big-endian number; `depth` bytes of zeros follow
    the text, which has none itself, so that a suffix that ends is smaller than its extensions.
    """
    n = len(t)
    if n == 0:
        return
    s_type, kind_of = _s_type(t), np.int32 if n < 2**31 else np.int64
    keys, seeds = [], Queue(folder / "seeds", held)
    for begin in range(0, n, PIECE):
        here = s_type[begin : begin + PIECE]
        before = np.concatenate(([s_type[begin - 1] if begin else True], here[:-1]))
        at = (np.flatnonzero(here & ~before) + begin).astype(kind_of)
        seeds.push(t[at], at)
        keys = sorted({*keys, *np.unique(t[begin : begin + PIECE]).tolist()})

    def predecessors(block: np.ndarray, kind: bool) -> np.ndarray:
        before = block[block > 0] - 1
        return before[s_type[before] == kind]

    rising, falling = Queue(folder / "rising", held), Queue(folder / "falling", held)
    l_part, s_part = Queue(folder / "l", held), Queue(folder / "s", held)
    rising.push(t[-1:], np.array([n - 1], dtype=kind_of))
    for key in keys:
        while len(block := rising.take(key)):
            l_part.put(key, block)
            before = predecessors(block, False)
            rising.push(t[before], before)
        block = seeds.take(key)
        block = block[np.lexsort([words[block.astype(np.int64) + k].astype(np.uint64) for k in range(0, depth, 8)][::-1])]
        before = predecessors(block, False)
        rising.push(t[before], before)
    for key in reversed(keys):
        while len(block := falling.take(key)):
            s_part.put(key, block)
            before = predecessors(block, True)
            falling.push(t[before], before)
        block = l_part.take(key)
        l_part.put(key, block)
        before = predecessors(block[::-1], True)
        falling.push(t[before], before)
    for key in keys:
        yield np.concatenate((l_part.take(key), s_part.take(key)[::-1]))


def covered(contexts: Iterator[tuple[list[bytes], np.ndarray]], length: int, held: int = HELD) -> tuple[np.ndarray, np.ndarray]:
    """`contexts`: batches of byte strings and of the smallest document that has each.

    Gives the sizes of all contexts and, for their concatenation, at which places a string of
    `length` bytes starts, inside its context, that a context with a smaller document also has.
    The text is on disk and mapped.
    """
    with tempfile.TemporaryDirectory() as name:
        folder, sizes, least = Path(name), [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        with (folder / "text").open("wb") as f:
            for texts, docs in contexts:
                f.write(b"".join(texts))
                sizes.append(np.array([len(x) for x in texts], dtype=np.int64))
                least.append(np.asarray(docs, dtype=np.int64))
            f.write(bytes(length + 16))
        sizes, least = np.concatenate(sizes), np.concatenate(least)
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ends) else 0
        text = np.memmap(folder / "text", dtype=np.uint8, mode="r+")
        for begin in range(0, n, PIECE):  # zero is for the end; UTF-8 has no byte 255
            text[begin : min(n, begin + PIECE)] += 1
        words = np.ndarray((n + length + 8,), dtype=">u8", buffer=text, strides=(1,))
        out = np.zeros(n, dtype=bool)
        for block in suffix_order(text[:n], words, length, folder, held):
            block = block.astype(np.int64)
            own = np.searchsorted(ends, block, side="right")
            inside = block + length <= ends[own]
            block, docs = block[inside], least[own[inside]]
            if len(block) < 2:
                continue
            same = np.ones(len(block) - 1, dtype=bool)
            for k in [*range(0, length - 8, 8), length - 8]:
                x = words[block + k]
                same &= x[1:] == x[:-1]
            group = np.concatenate(([0], np.cumsum(~same)))
            smallest = np.minimum.reduceat(docs, np.flatnonzero(np.concatenate(([True], ~same))))
            out[block[docs > smallest[group]]] = True
        del words, text
    return sizes, out


# The operator -------------------------------------------------------------------------------------


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def _small(df: DataFrame) -> DataFrame:
    """`df` with a broadcast hint if it is small by count."""
    return F.broadcast(df) if df.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else df


_COLUMNS = ("anchor", "sides", "context", "size", "doc", "start")
_MEETING = ", ".join(f"{x} long" for x in _COLUMNS)
#: Contexts that a task gathers before it deals them out.
DEALT = 1 << 17
#: Contexts handed to the JVM at once, and bytes of text whose contexts one task orders.
HANDED, ORDERED = 1 << 15, 8 << 20
#: Contexts of one anchor that are looked at together; of anchors with more, all unlike contexts are
#: compared as bytes, whether their sides agree or not.
TOGETHER = 100_000


def _deal(length: int, parts_bits: int):
    """Contexts of documents by ranges of anchors: part, and a compressed block of columns."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, squeeze = Contexts(length), zstandard.ZstdCompressor(level=1)
        gathered, n = [], 0

        def deal() -> pa.RecordBatch:
            columns = np.concatenate(gathered, axis=1)
            columns = columns[:, np.lexsort((columns[2], columns[0]))]
            part = columns[0] >> (ANCHOR_BITS - parts_bits)
            cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
            blocks = []
            for block in np.split(columns, cuts, axis=1):
                block = block.copy()
                block[0, 1:] = np.diff(block[0])
                # byte planes: the many equal high bytes of small numbers lie side by side
                blocks.append(squeeze.compress(np.ascontiguousarray(block.view(np.uint8).reshape(-1, 8).T).tobytes()))
            ids = part[np.concatenate(([0], cuts))]
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(blocks, pa.binary())], names=["part", "block"])

        for batch in batches:
            doc, shift = (batch.column(k).to_numpy() for k in (0, 1))
            texts = (x.as_py() for x in batch.column(2).cast(pa.binary()))
            for which, start, size, anchor, sides, value in contexts.batches(texts):
                if len(start):
                    gathered.append(np.stack([anchor, sides, value, size, doc[which], start + shift[which]]).astype(np.int64))
                    n += len(start)
                if n >= DEALT:
                    yield deal()
                    gathered, n = [], 0
        if gathered:
            yield deal()

    return find


def _undeal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        for block in batch.column(1):
            planes = np.frombuffer(expand.decompress(block.as_py()), dtype=np.uint8).reshape(8, -1)
            columns = np.ascontiguousarray(planes.T).view(np.int64).reshape(len(_COLUMNS), -1)
            columns[0] = np.cumsum(columns[0])
            whole = pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=list(_COLUMNS))
            for begin in range(0, whole.num_rows, HANDED):
                yield whole.slice(begin, HANDED)


def _judge(rows: np.ndarray, least: int | None, hot: bool) -> np.ndarray:
    """Of contexts in order (a column each): those whose document is not the smallest with the context,
    which lose it whole, marked by anchor -1, and those whose bytes must be compared.

    `least`: smallest document of the first context, if it began earlier. `hot`: part of a large
    group, all of whose contexts are to be compared.
    """
    anchor, sides, context, size, doc, start = rows
    new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
    new = new_anchor | np.concatenate(([True], (context[1:] != context[:-1]) | (size[1:] != size[:-1])))
    number = np.cumsum(new) - 1
    smallest = doc[new]
    if least is not None:
        smallest[0] = least
    later = doc > smallest[number]
    whole = rows[:, later].copy()
    whole[0] = -1
    first = rows[:, ~later]
    if not hot:
        # several contexts of several documents, and one side in common with another context
        group = np.cumsum(new_anchor)[new] - 1
        wanted = np.zeros(len(smallest), dtype=bool)
        for part in (sides[new] >> 8 & 255, sides[new] & 255):
            key = group * 256 + part
            order = np.lexsort((smallest, key))
            k, d = key[order], smallest[order]
            begin = np.concatenate(([True], k[1:] != k[:-1]))
            low, high = np.minimum.reduceat(d, np.flatnonzero(begin)), np.maximum.reduceat(d, np.flatnonzero(begin))
            unlike = (low < high)[np.cumsum(begin) - 1]
            wanted[order] |= unlike & (part[order] > 0)
        # equal contexts may have unlike sides outside them, and tied ones have several
        many = sides[new] >= TIED
        uneven = np.concatenate(([False], (sides[1:] != sides[:-1]) & ~new[1:]))
        many[number[uneven]] = True
        big = np.bincount(group[many], minlength=group[-1] + 1)[group] > 0
        several = np.bincount(group)[group] > 1
        first = first[:, (wanted | big & several)[number[~later]]]
    return np.concatenate((whole, first), axis=1)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`_judge` over a sorted stream, of which one anchor's contexts are held up to `TOGETHER`."""

    def out(rows: np.ndarray) -> pa.RecordBatch:
        anchor = pa.array(rows[0], mask=rows[0] < 0)
        return pa.RecordBatch.from_arrays([anchor, *[pa.array(rows[k]) for k in (4, 5, 3)]], names=["anchor", "doc", "start", "size"])

    held = np.zeros((len(_COLUMNS), 0), dtype=np.int64)
    hot = None  # of a large group: anchor, context, size and its smallest document
    for batch in batches:
        rows = np.concatenate((held, np.stack([x.to_numpy() for x in batch.columns])), axis=1)
        if not rows.shape[1]:
            continue
        begin = 0
        if hot and rows[0, 0] == hot[0]:
            n = int(np.searchsorted(rows[0], hot[0], side="right"))
            goes_on = (rows[2, 0], rows[3, 0]) == hot[1:3]
            yield out(_judge(rows[:, :n], hot[3] if goes_on else None, True))
            begin = n
            if n == rows.shape[1]:
                last = rows[:, -1]
                of_last = rows[:, (rows[2] == last[2]) & (rows[3] == last[3])]
                same = goes_on and (last[2], last[3]) == hot[1:3]
                hot, held = (hot[0], last[2], last[3], hot[3] if same else of_last[4].min()), rows[:, :0]
                continue
        hot = None
        end = int(np.searchsorted(rows[0], rows[0, -1], side="left"))
        if end > begin:
            yield out(_judge(rows[:, begin:end], None, False))
        begin = max(begin, end)
        held = rows[:, begin:]
        if held.shape[1] > TOGETHER:
            yield out(_judge(held, None, True))
            last = held[:, -1]
            of_last = held[:, (held[2] == last[2]) & (held[3] == last[3])]
            hot, held = (last[0], last[2], last[3], of_last[4].min()), held[:, :0]
    if held.shape[1]:
        yield out(_judge(held, None, False))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc, shift and the compressed text."""
    squeeze = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        data = [squeeze.compress(x.as_py()) for x in batch.column(2).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], names=["doc", "shift", "data"])


def _bytes_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the places asked for, which are all of the row's own text."""
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for doc, shift, data, places in zip(batch.doc, batch["shift"], batch.data, batch.places):
            text = expand.decompress(data)
            for p in places:
                at = p["start"] - shift
                rows.append((p["anchor"], doc, p["start"], text[at : at + p["size"]]))
        yield pd.DataFrame(rows, columns=["anchor", "doc", "start", "bytes"])


def _cuts(length: int):
    """Removed spans in the contexts of a shard's anchors."""

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        docs, starts = [], []

        def contexts() -> Iterator[tuple[list[bytes], np.ndarray]]:
            for batch in batches:
                docs.append(batch.doc.to_numpy())
                starts.append(batch.start.to_numpy())
                yield list(batch.bytes), batch.doc.to_numpy()

        sizes, found = covered(contexts(), length)
        if not found.any():
            return
        begins, at = np.cumsum(sizes) - sizes, np.flatnonzero(found)
        own = np.searchsorted(begins, at, side="right") - 1
        # runs of starts inside one context
        first = np.concatenate(([True], (own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1)))
        last = np.concatenate((first[1:], [True]))
        place = own[first]
        begin = np.concatenate(starts)[place] + at[first] - begins[place]
        yield pd.DataFrame({
            "doc": np.concatenate(docs)[place], "start": begin, "size": at[last] - at[first] + length,
        })

    return sort


def spans(begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Union of half-open spans as rows (begin, end), in order, touching ones merged."""
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    first = np.concatenate(([True], begins[1:] > reach[:-1]))
    return np.stack((begins[first], reach[np.concatenate((first[1:], [True]))]), axis=1)


def _cut_texts(with_text: bool):
    columns = ["doc", "shift", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_text]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for doc, shift, data, marks in zip(batch.doc, batch["shift"], batch.data, batch.marks):
                text = expand.decompress(data)
                begins = np.array([m["start"] for m in marks], dtype=np.int64) - shift
                gone = spans(begins, begins + np.array([m["size"] for m in marks], dtype=np.int64))
                at, kept = 0, []
                for a, b in gone.tolist():
                    kept.append(text[at:a])
                    at = b
                kept = b"".join([*kept, text[at:]])
                removed = int((gone[:, 1] - gone[:, 0]).sum())
                rows.append((doc, shift, removed, len(gone), hashlib.sha256(kept).hexdigest(), *[kept] * with_text))
            yield pd.DataFrame(rows, columns=columns)

    return cut


def _with_shift(texts: DataFrame, base: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """doc, shift, text of each distinct text of a doc_id, and the shifts other than 0 if any.

    A text of a doc_id with several has a number of its own, from 1, and the shift is that number
    above `PLACE_BITS`; single texts have 0. No step holds the texts or places of one id together.
    """
    texts = texts.select("doc", "sha", "text")
    rows = stored(base.groupBy("doc", "sha").agg(F.count(F.lit(1)).alias("n")), "rows")
    again = stored(rows.where("n > 1").select("doc", "sha"), "again")
    if not again.isEmpty():  # equal rows lose the same, and are cut once
        equal = _small(again)
        once = stored(texts.join(equal, ["doc", "sha"], "left_semi").dropDuplicates(["doc", "sha"]), "equal")
        texts = texts.join(equal, ["doc", "sha"], "left_anti").unionByName(once)
    several = stored(rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc"), "several")
    if several.isEmpty():
        return texts.select("doc", F.lit(0).cast("long").alias("shift"), "text"), None
    at = F.monotonically_increasing_id()
    kinds = stored(rows.join(_small(several), "doc", "left_semi").select("doc", "sha").withColumn("at", at), "kinds")
    part = F.shiftright("at", 33)
    counts = {r.part: r.n for r in kinds.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    before = F.create_map(*[F.lit(x) for k in sorted(counts) for x in (k, sum(n for j, n in counts.items() if j < k))])
    number = before[part] + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    shifts = stored(kinds.select("doc", "sha", F.shiftleft(number.cast("long"), PLACE_BITS).alias("shift")), "shifts")
    found = texts.join(_small(shifts), ["doc", "sha"], "left")
    return found.select("doc", F.coalesce("shift", F.lit(0)).cast("long").alias("shift"), "text"), shifts


def _by_text(places: DataFrame, name: str, *columns: str) -> DataFrame:
    """doc, shift and the array `name` of the text's `places` (doc, start and other `columns`)."""
    shift = F.shiftleft(F.shiftright("start", PLACE_BITS), PLACE_BITS).alias("shift")
    return places.groupBy("doc", shift).agg(F.collect_list(F.struct(*columns)).alias(name))


def remove_repeats(docs: DataFrame, length: int = 50, with_text: bool = True) -> DataFrame:
    """Remove every byte covered by a `length`-byte string that a smaller doc_id also has.

    One row per row of `docs` (doc_id, text): doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 and, `with_text`, kept (remaining bytes; null where nothing is removed, so that
    untouched texts are not moved). Texts count as UTF-8 bytes; strings are judged on the input.

    Null text is empty. Rows with one doc_id never remove each other, whatever their texts. A null
    doc_id counts as larger than all others. Texts shorter than `length`, and an empty table, lose
    nothing; other columns are ignored. `length` is from 32 to 78. Equal contexts are told by their
    size, 48 bits of their anchor's hash and a 64-bit hash of their own.
    """
    own = docs.select("doc_id", F.coalesce("doc_id", F.lit(_TOP)).cast("long").alias("doc"), _text().alias("text"))
    with_sha = own.withColumn("sha", F.unhex(F.sha2("text", 256)))
    base = stored(with_sha.select("doc_id", "doc", "sha", F.octet_length("text").cast("long").alias("n_bytes")), "base")
    least = base.where(F.col("n_bytes") >= length).groupBy("sha").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    several = stored(least.where(F.col("least") < F.col("most")).select("sha", "least"), "copied")
    copies = base.join(_small(several), "sha").where(F.col("doc") > F.col("least")).select("doc", "sha").distinct()
    copies = stored(copies, "copies")
    first = with_sha.where(F.octet_length("text") >= length).join(_small(copies), ["doc", "sha"], "left_anti")
    first, shifts = _with_shift(first, base)

    # by bytes of text: blocks are compressed, so their size does not tell how many contexts they hold
    tasks = max(1, -(-(base.agg(F.sum("n_bytes")).first()[0] or 0) // ORDERED))
    parts = 8 * max(tasks, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    met = stored(
        first.mapInArrow(_deal(length, min(24, parts.bit_length())), "part long, block binary")
        .repartition(tasks, "part").mapInArrow(_undeal, _MEETING)
        .sortWithinPartitions("anchor", "context", "size", "doc", "start")
        .mapInArrow(_meet, "anchor long, doc long, start long, size long"),
        "contexts",
    )
    places = stored(_by_text(met.where("anchor is not null"), "places", "anchor", "start", "size"), "places")
    packed, text = "doc long, shift long, data binary", ["doc", "shift"]
    wanted = first.join(_small(places.select(*text)), text, "left_semi").mapInArrow(_packed, packed)
    cuts = (
        wanted.join(places, text)
        .mapInPandas(_bytes_of, "anchor long, doc long, start long, bytes binary")
        .repartition("anchor")
        .mapInPandas(_cuts(length), "doc long, start long, size long")
    )
    marks = met.where("anchor is null").select("doc", "start", "size").unionByName(cuts)
    marks = stored(_by_text(marks, "marks", "start", "size"), "marks")
    touched = first.join(_small(marks.select(*text)), text, "left_semi").mapInArrow(_packed, packed)
    out = "doc long, shift long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    lost = touched.join(marks, text).mapInPandas(_cut_texts(with_text), out)

    if shifts is None:
        placed = base.withColumn("shift", F.lit(0).cast("long"))
    else:
        placed = base.join(shifts, ["doc", "sha"], "left").withColumn("shift", F.coalesce("shift", F.lit(0)))
    copied, empty = F.col("copied").isNotNull(), F.lit(hashlib.sha256(b"").hexdigest())
    kept = [F.when(copied, F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if with_text else []
    return (
        placed.join(copies.withColumn("copied", F.lit(True)), ["doc", "sha"], "left")
        .join(lost, ["doc", "shift"], "left")
        .select(
            "doc_id", "n_bytes",
            F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(copied, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(copied, empty).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"), *kept,
        )
    )
