"""Operator 13, phrase collocation mining by SON partitioning.

Texts are cut into pieces and words; a phrase is up to ``LONGEST`` words of one piece.

1. Every shard, about ``SHARD`` bytes of the documents of a task, is mined completely: all
   its phrases that reach the local support, the global one lowered to the shard's share of
   all bytes, with their counts.
2. The locally frequent phrases are united. A phrase that no shard reports cannot be frequent;
   of the others, those go that stay below the support even if every silent shard holds as many
   as it may without reporting.
3. The candidates that are left are counted exactly over all documents, by their text.

Words and pairs go first; of longer phrases only those are mined whose pairs are all frequent.
What a task must know of the candidates or of the frequent pairs reaches it as a bitmap of
hashed keys of at most ``FILTER_BITS`` bits, whatever their number; a false hit costs a row and
changes no count. From 30 shards on a local support of 30 / shards is one occurrence, so the
first step then reports every phrase of a shard once, with its count.

Null text is empty; a null language is ``und``; doc_id is not read, so repeated rows and ids
count each; an empty table gives no rows; further columns are ignored. Phrases are told apart
by their text; within one shard and in the candidate filter by a 64-bit hash.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adoptlens.llm.hashing import BYTE_CODE, LOWER, gram_hash, mix, prefix_sums, range_hash, word_bounds
from adoptlens.llm.tables import discard, stored

#: Bytes of a shard and of a step in it; most bits of a shared filter; words of the longest phrase.
SHARD, STEP, FILTER_BITS, LONGEST = 4 << 20, 1 << 20, 1 << 30, 4
#: Bits of one bitmap of Spark's bitmap functions.
BUCKET = 32768


def _flags(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: Signs that end a piece; these and blanks end a word.
ENDS = _flags(b".,;:!?\n\x0b\f\r")
END = re.compile(rb"[.,;:!?\n\x0b\f\r]")
BETWEEN = ENDS | _flags(b" \t")


class Shard:
    """Words of some texts in one row: bytes, place, code, piece and language of each."""

    def __init__(self, raw: list[bytes], langs: list[str]):
        lengths = np.array([len(x) + 1 for x in raw], np.int64)
        self.buf = LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
        self.start, self.end = word_bounds(self.buf, BETWEEN)
        codes = []
        cuts = np.searchsorted(self.start, np.arange(0, len(self.buf), STEP))
        for a, b in zip(cuts, np.append(cuts[1:], len(self.start))):
            if a < b:
                low = self.start[a]
                sums = prefix_sums(BYTE_CODE[self.buf[low : self.end[b - 1]]])
                codes.append(range_hash(sums, self.start[a:b] - low, self.end[a:b] - low))
        self.codes = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        self.piece = np.searchsorted(np.flatnonzero(ENDS[self.buf]), self.start)
        self.langs = sorted(set(langs))
        number = {x: i for i, x in enumerate(self.langs)}
        of_text = np.array([number[x] for x in langs], np.int64)
        self.lang = of_text[np.searchsorted(np.cumsum(lengths), self.start, side="right")]
        seeds = [int.from_bytes(x.encode()[:8].ljust(8, b"\0"), "little") ^ (hash_of(x)) for x in self.langs]
        self.salt = mix(np.array(seeds, np.uint64))

    def keys(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and key (language and words) of every phrase of ``k`` words."""
        n = len(self.codes) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.piece[:n] == self.piece[k - 1 :])
        return at, mix(gram_hash(self.codes, k)[at] ^ self.salt[self.lang[at]])

    def texts(self, at: np.ndarray, k: int) -> pa.Array:
        """Phrases of ``k`` words from the given words on."""
        words = [self._words(at + j) for j in range(k)]
        return (pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary())) if k > 1 else words[0]).cast(pa.string())

    def _words(self, at: np.ndarray) -> pa.Array:
        length = self.end[at] - self.start[at]
        ends = np.concatenate([[0], np.cumsum(length)])
        data = self.buf[np.repeat(self.start[at] - ends[:-1], length) + np.arange(ends[-1])]
        return pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])


def hash_of(lang: str) -> int:
    raw = np.frombuffer(lang.encode(), np.uint8)
    return int(range_hash(prefix_sums(BYTE_CODE[raw]), np.array([0]), np.array([len(raw)]))[0])


class Keys:
    """Keys in a bitmap, each at two places; ``has`` may say yes to others, never no to these."""

    def __init__(self, bits: int, bitmap: np.ndarray):
        self.bits, self.bitmap = bits, bitmap

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for place in (keys >> np.uint64(64 - self.bits), keys & np.uint64((1 << self.bits) - 1)):
            found &= (self.bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def keys_of(rows: DataFrame) -> Keys:
    """The ``key`` column as a filter, about 16 bits a key and ``FILTER_BITS`` at most."""
    n = rows.count()
    bits = max(16, min(int(math.log2(FILTER_BITS)), int(math.ceil(math.log2(16 * max(1, n))))))
    low = F.expr(f"key & {(1 << bits) - 1}L")
    places = rows.select(F.explode(F.array(F.shiftrightunsigned("key", 64 - bits), low)).alias("place"))
    parts = places.groupBy(F.floor(F.col("place") / BUCKET).alias("bucket")).agg(F.bitmap_construct_agg(F.pmod("place", F.lit(BUCKET))).alias("bitmap"))
    bitmap = np.zeros((1 << bits) // 8, np.uint8)
    size = BUCKET // 8
    for r in parts.toLocalIterator():  # at most FILTER_BITS / 8 bytes in all
        bitmap[r.bucket * size : (r.bucket + 1) * size] = np.frombuffer(r.bitmap, np.uint8)
    return Keys(bits, bitmap)


def _cut(text: bytes, size: int):
    """A text, or its parts of about ``size`` bytes; no piece is divided."""
    at = 0
    while len(text) - at > size and (sign := END.search(text, at + size)):
        yield text[at : sign.end()]
        at = sign.end()
    yield text[at:]


def _shards(batches, size: int):
    """Shards of about ``size`` bytes with their bytes; a long text is dealt to several."""
    raw, langs, held = [], [], 0
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for text, lang in zip(texts, batch.column("lang").to_pylist()):
            for part in _cut(text.as_py(), size):
                if raw and held + len(part) > size:
                    yield Shard(raw, langs), held
                    raw, langs, held = [], [], 0
                raw.append(part)
                langs.append(lang)
                held += len(part)
    if raw:
        yield Shard(raw, langs), held


def _allowed(shard: Shard, k: int, at: np.ndarray, pairs: Keys | None) -> np.ndarray:
    """Phrases of ``k`` words all of whose pairs may be frequent."""
    if pairs is None or k < 3:
        return np.ones(len(at), bool)
    good = np.zeros(len(shard.codes), bool)
    first, keys = shard.keys(2)
    good[first] = pairs.has(keys)
    return np.logical_and.reduce([good[at + j] for j in range(k - 1)])


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    last = np.flatnonzero(np.append(keys[1:] != keys[:-1], True)[: len(keys)])
    return keys[last], np.diff(last, prepend=-1)


def _candidates(rows: DataFrame, lengths: tuple[int, ...], support: int, total: int, pairs: Keys | None, size: int) -> DataFrame:
    """(key): phrases that some shard reports and that may reach the support."""
    shared = rows.sparkSession.sparkContext.broadcast(pairs)  # at most FILTER_BITS

    def mine(batches):
        for shard, held in _shards(batches, size):
            local = max(1, -(-support * held // total))
            # what the shard may hold of a phrase without reporting it
            yield pa.record_batch([pa.nulls(1, pa.int64()), pa.array([local - 1], pa.int64())], names=["key", "n"])
            for k in lengths:
                at, keys = shard.keys(k)
                keys, counts = _counted(keys[_allowed(shard, k, at, shared.value)])
                enough = counts >= local
                yield pa.record_batch([pa.array(keys[enough].view(np.int64)), pa.array(counts[enough] - (local - 1), pa.int64())], names=["key", "n"])

    found = stored(rows.mapInArrow(mine, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("key").isNull() | (F.col("n") > 0)), "son-candidates")
    silent = (found.where("key is null").first() or (None, 0))[1]
    least = found.where(F.col("key").isNotNull() & (F.col("n") >= support - silent)).select("key")
    least.stored_at = found.stored_at
    return least


def _frequent(rows: DataFrame, lengths: tuple[int, ...], support: int, candidates: Keys, pairs: Keys | None, size: int) -> DataFrame:
    """(lang, k, phrase, key, a): exact counts of the candidates that reach the support; k 0: all words of a language."""
    shared = rows.sparkSession.sparkContext.broadcast((candidates, pairs))  # at most twice FILTER_BITS
    schema = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("key", pa.int64()), ("n", pa.int64())])

    def count(batches):
        wanted, pairs = shared.value
        for shard, _ in _shards(batches, size):
            langs = pa.array(shard.langs, pa.string())
            if 1 in lengths:
                n = np.bincount(shard.lang, minlength=len(langs))
                yield pa.record_batch([langs, pa.array(np.zeros(len(n)), pa.int32()), pa.nulls(len(n), pa.string()), pa.nulls(len(n), pa.int64()), pa.array(n, pa.int64())], schema=schema)
            for k in lengths:
                at, keys = shard.keys(k)
                some = wanted.has(keys) & _allowed(shard, k, at, pairs)
                at, keys = at[some], keys[some]
                order = np.argsort(keys, kind="stable")
                last = np.flatnonzero(np.append(keys[order][1:] != keys[order][:-1], True)[: len(keys)])
                one, counts = order[last], np.diff(last, prepend=-1)
                yield pa.record_batch([langs.take(pa.array(shard.lang[at[one]])), pa.array(np.full(len(one), k), pa.int32()), shard.texts(at[one], k), pa.array(keys[one].view(np.int64)), pa.array(counts, pa.int64())], schema=schema)

    counted = rows.mapInArrow(count, "lang string, k int, phrase string, key long, n long")
    counted = counted.groupBy("lang", "k", "phrase", "key").agg(F.sum("n").alias("a"))
    return stored(counted.where(F.col("k").eqNullSafe(0) | (F.col("a") >= support)), "son-frequent")


def frequent(docs: DataFrame, support: int = 30, size: int = SHARD) -> DataFrame:
    """(lang, k, phrase, a) of every phrase of 1 to ``LONGEST`` words found ``support`` times in its language, and (lang, 0, null, words)."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    rows = docs.select(text, F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    total = max(1, rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    out, pairs = None, None
    for lengths in ((1, 2), tuple(range(3, LONGEST + 1))):
        candidates = _candidates(rows, lengths, support, total, pairs, size)
        found = _frequent(rows, lengths, support, keys_of(candidates), pairs, size)
        discard(candidates)
        out = found if out is None else out.union(found)
        pairs = keys_of(found.where("k = 2").select("key")) if pairs is None else pairs
    return out.select("lang", "k", "phrase", "a")


def _part(words: str, first: Column, count: Column) -> Column:
    return F.array_join(F.slice(words, first, count), " ")


def collocations(docs: DataFrame, support: int = 30, scale: int = 2_000_000, contained: int = 80, top: int = 2000, size: int = SHARD) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score.

    ``score``: floor(scale * a / (l + r)) at the lowest of all cuts into two parts; phrases go
    that lie inside a longer one found at least ``contained`` times in a hundred of theirs.
    """
    every = frequent(docs, support, size)
    exact = "decimal(30,0)"
    counts = every.where("k > 0").select("lang", "phrase", "a")
    phrases = every.where("k > 1").withColumn("w", F.split("phrase", " "))
    cut = F.explode(F.sequence(F.lit(1), F.col("k") - 1))
    cuts = phrases.select("lang", "phrase", "a", "k", "w", cut.alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _part("w", F.lit(1), F.col("cut")).alias("left"), _part("w", F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("a").alias(name)), ["lang", side])
    score = F.expr(f"(cast(a as {exact}) * {scale}) div (cast(l as {exact}) + cast(r as {exact}))")
    lowest = cuts.select("lang", "phrase", "a", F.struct(score.alias("score"), "cut", "l", "r").alias("cut"))
    lowest = lowest.groupBy("lang", "phrase", "a").agg(F.min("cut").alias("cut"))
    # contiguous parts of two words and more, with the most frequent phrase around each
    spans = F.filter(F.flatten(F.transform(F.sequence(F.lit(1), F.col("k")), lambda i: F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.col("k") - 1)), lambda m: F.struct(i.alias("i"), m.alias("m"))))), lambda s: s["i"] + s["m"] - 1 <= F.col("k"))
    inside = phrases.where("k > 2").select("lang", "a", "w", F.explode(spans).alias("s")).select("lang", "a", _part("w", F.col("s.i"), F.col("s.m")).alias("phrase"))
    around = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    held = (100 * F.col("longer").cast(exact)) >= (contained * F.col("a").cast(exact))
    left = lowest.join(around, ["lang", "phrase"], "left").where(~F.coalesce(held, F.lit(False)))
    left = left.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    words = every.where("k = 0").select("lang", F.col("a").alias("n"))
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
