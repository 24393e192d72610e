"""Operator 11, fill-in-middle transformation with a Roaring-style boundary set.

The texts of a block lie end to end in one byte buffer, and the places where a unit (character,
word or line) begins are kept as a compressed set: 65,536 places to a container, which is a
sorted array, a bitmap or a list of runs, whichever is smallest, with the cardinalities of the
containers summed up. The unit at which a text is cut is a rank in that set: the container is
found in the sums, a select inside it gives the byte offset, for both cuts of all texts at once.

Where the cuts fall and which form a text takes follow from a hash of its id. A null text counts
as empty and stays plain, as do texts that hold one of the marks; a null id is hashed as no
digits; every row is transformed by itself, repeated rows and ids too; an empty table gives no
rows; columns of the result's names give way, all others are kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from adoptlens.llm.hashing import IS_SPACE
from adoptlens.llm.tokens import text_blocks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Columns that ``transform`` adds.
RESULTS = ("n", "form", "prefix_units", "middle_units", "output")
#: Places of a container; bytes of its bitmap; characters that a task works on at once.
SPAN, BITMAP, STEP = 1 << 16, 1 << 13, 1 << 20

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
#: For every byte, the places of its set bits in order.
_SELECT = np.argsort(1 - _BITS, axis=1, kind="stable").astype(np.int64)
_COUNT = _BITS.sum(axis=1).astype(np.int64)


class ArrayContainer:
    """Sorted places, 2 bytes each."""

    def __init__(self, places: np.ndarray):
        self.places = places.astype(np.uint16)

    def select(self, rank: np.ndarray) -> np.ndarray:
        return self.places[rank].astype(np.int64)

    def rank(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.places, place)


class BitmapContainer:
    """A bit per place, with the set bits before each byte."""

    def __init__(self, places: np.ndarray):
        bits = np.zeros(SPAN, np.uint8)
        bits[places] = 1
        self.bytes = np.packbits(bits, bitorder="little")
        self.before = np.concatenate([[0], np.cumsum(_COUNT[self.bytes])]).astype(np.int32)

    def select(self, rank: np.ndarray) -> np.ndarray:
        byte = np.searchsorted(self.before, rank, side="right") - 1
        return byte * 8 + _SELECT[self.bytes[byte], rank - self.before[byte]]

    def rank(self, place: np.ndarray) -> np.ndarray:
        byte = np.minimum(place >> 3, BITMAP - 1)
        mask = (1 << np.minimum(place - byte * 8, 8)) - 1
        return self.before[byte] + _COUNT[self.bytes[byte] & mask]


class RunContainer:
    """First place and length of each run, 4 bytes each, with the places before each run."""

    def __init__(self, first: np.ndarray, length: np.ndarray):
        self.first = first.astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)

    def select(self, rank: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.before, rank, side="right") - 1
        return (self.first[run] + rank - self.before[run]).astype(np.int64)

    def rank(self, place: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.first, place, side="right") - 1
        inside = np.minimum(place - self.first[run], self.before[run + 1] - self.before[run])
        return np.where(run < 0, 0, self.before[run] + inside)


def container(places: np.ndarray):
    """The smallest container for sorted places below ``SPAN``."""
    edge = np.flatnonzero(np.diff(places) != 1)
    runs = len(edge) + 1 if len(places) else 0
    sizes = {"run": 2 + 4 * runs, "array": 2 * len(places), "bitmap": BITMAP}
    kind = min(sizes, key=sizes.get)
    if kind == "array":
        return ArrayContainer(places)
    if kind == "bitmap":
        return BitmapContainer(places)
    first = places[np.concatenate([[0], edge + 1])]
    last = places[np.concatenate([edge, [len(places) - 1]])]
    return RunContainer(first, last - first + 1)


class BoundarySet:
    """Places in a buffer of ``size`` bytes; ``marks(a, b)`` flags those in [a, b)."""

    def __init__(self, marks, size: int):
        self.containers, counts = [], []
        for a in range(0, size + 1, SPAN):
            places = np.flatnonzero(marks(a, min(a + SPAN, size + 1)))
            self.containers.append(container(places))
            counts.append(len(places))
        self.before = np.concatenate([[0], np.cumsum(counts)])

    def __len__(self) -> int:
        return int(self.before[-1])

    def _each(self, number: np.ndarray, values: np.ndarray, method: str) -> np.ndarray:
        out = np.zeros(len(values), np.int64)
        order = np.argsort(number, kind="stable")
        cuts = np.flatnonzero(np.diff(number[order], prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(order))):
            own = order[a:b]
            out[own] = getattr(self.containers[number[own[0]]], method)(values[own])
        return out

    def select(self, rank: np.ndarray) -> np.ndarray:
        """The place of each rank, counted from 0."""
        number = np.searchsorted(self.before, rank, side="right") - 1
        return number * SPAN + self._each(number, rank - self.before[number], "select")

    def rank(self, place: np.ndarray) -> np.ndarray:
        """How many places of the set lie before each place."""
        number = place // SPAN
        return self.before[number] + self._each(number, place - number * SPAN, "rank")


def _characters(part: np.ndarray, previous: np.ndarray) -> np.ndarray:
    return (part & 0xC0) != 0x80


def _words(part: np.ndarray, previous: np.ndarray) -> np.ndarray:
    return ~IS_SPACE[part] & IS_SPACE[previous]


def _lines(part: np.ndarray, previous: np.ndarray) -> np.ndarray:
    return previous == 10


#: Whether a unit begins at each byte, told from it and the byte before.
UNITS = {"characters": _characters, "words": _words, "lines": _lines}


def boundaries(buf: np.ndarray, begin: np.ndarray, end: np.ndarray, units: str) -> BoundarySet:
    """First bytes of the units of all texts, and the buffer's end; a text's first byte begins a unit."""
    starts = np.unique(np.append(begin[end > begin], len(buf)))

    def marks(a: int, b: int) -> np.ndarray:
        part = buf[a:b]
        previous = np.concatenate([buf[a - 1 : a] if a else np.array([10], np.uint8), part[:-1]])
        found = np.append(UNITS[units](part, previous), [False] * (b - a - len(part)))
        found[starts[(starts >= a) & (starts < b)] - a] = True
        return found

    return BoundarySet(marks, len(buf))


def _hashes(seed: str, ids: list) -> np.ndarray:
    """The first four 32-bit numbers of the hash of every id."""
    digests = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids]
    return np.frombuffer(b"".join(digests), ">u4").reshape(-1, 4).astype(np.int64)


def arranged(raw: list[bytes], ids: list, seed: str, units: str, plain: int, spm: int):
    """Units, form, units of prefix and middle, and output of each text of a block."""
    lengths = np.array([len(x) for x in raw], np.int64)
    end = np.cumsum(lengths)
    begin = end - lengths
    places = boundaries(np.frombuffer(b"".join(raw), np.uint8), begin, end, units)
    first = places.rank(begin)
    n = places.rank(end) - first
    h = _hashes(seed, ids)
    low, high = np.minimum(h[:, 0] % (n + 1), h[:, 1] % (n + 1)), np.maximum(h[:, 0] % (n + 1), h[:, 1] % (n + 1))
    cut = places.select(np.concatenate([first + low, first + high]))
    a, b = cut[: len(raw)] - begin, cut[len(raw) :] - begin
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    for i, text in enumerate(raw):
        if not text or h[i, 2] % 100 >= plain or p in text or s in text or m in text:
            yield int(n[i]), "plain", None, None, text
            continue
        head, middle, tail = text[: a[i]], text[a[i] : b[i]], text[b[i] :]
        form = "spm" if h[i, 3] % 100 < spm else "psm"
        parts = (s, tail, p, head, m, middle) if form == "spm" else (p, head, s, tail, m, middle)
        yield int(n[i]), form, int(low[i]), int(high[i] - low[i]), b"".join(parts)


def transform(docs: DataFrame, seed: str = "1", units: str = "characters", plain: int = 90, spm: int = 20) -> DataFrame:
    """``docs`` with the units of each text, its form (plain, psm or spm), the units of its prefix and middle, and ``output``.

    Of a hundred texts ``plain`` are cut, and of a hundred of these ``spm`` have the suffix first.
    """
    docs = docs.select(*[c for c in docs.columns if c.lower() not in RESULTS])
    added = [StructField("n", LongType()), StructField("form", StringType()), StructField("prefix_units", LongType()), StructField("middle_units", LongType()), StructField("output", StringType())]
    schema, names = StructType([*docs.schema.fields, *added]), docs.columns
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())

    def arrange(batches):
        for block in text_blocks(batches, STEP):
            raw = [x or b"" for x in block.column("text").cast(pa.binary()).to_pylist()]
            found = zip(*arranged(raw, block.column("doc_id").to_pylist(), seed, units, plain, spm))
            columns = [pa.array(c, k) for c, k in zip(found, kinds)]
            yield pa.record_batch([block.column(c) for c in names] + columns[:-1] + [columns[-1].view(pa.string())], names=schema.names)

    return docs.mapInArrow(arrange, schema)


def restored(output: Column, form: Column) -> Column:
    """The exact text, rebuilt from a transformed one and its form."""
    psm = F.regexp_replace(output, f"(?s)^{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*)$", "$1$3$2")
    spm = F.regexp_replace(output, f"(?s)^{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*)$", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
