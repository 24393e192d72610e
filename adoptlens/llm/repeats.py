"""Windows of a document that also start in a document with a smaller id, exactly.

Shared skeleton of the two exact substring operators; each brings its own way to compare the
texts that meet (``resolve``).

1. Every window of ``window`` symbols (words or bytes) is assigned to an anchor, its ``gram``
   of smallest hash, so equal windows have equal anchors wherever they stand. Neighbouring
   windows of one anchor occurrence form a segment; a segment's row is its anchor, the hash of
   its symbols, the document and the place. One shuffle by anchor follows: anchors of one
   document only are done, equal segments belong to the smallest document.
2. Only segments whose anchor has differing surroundings go on, one per distinct segment:
   their symbols meet by anchor and ``resolve`` compares them window by window.
3. The marks go back to their documents.

Skew: tasks settle repeats among their own rows before the shuffle, so a passage that a third
of all documents share sends one row per task. An anchor with many different surroundings
(within a task or in all) is split by window, whose equal copies are again settled per task.

With ``sources`` every mark also names the place in the smaller document that its first window
was found at, so that the caller can follow a copy through its reference.

Rows that share an id are told apart by a 64-bit hash of their text (``tag``), so marks are
gathered per distinct text; they never count as "smaller" than each other; a null id is larger
than every other. Null text has no symbols.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from adoptlens.llm.hashing import BYTE_CODE, IS_SPACE, gram_hash, mix, prefix_sums, range_hash, sliding_argmin, word_codes
from adoptlens.llm.tables import id_or_last, stored
from adoptlens.llm.tokens import text_blocks

#: Bytes of a text, symbols and rows that a task works on at once.
TEXT_STEP, SYMBOL_STEP, ROW_STEP = 1 << 20, 1 << 18, 1 << 18
#: Distinct surroundings of an anchor within a task, and rows of one in all, beyond which it is split by window.
CROWD, SPLIT = 64, 4096
#: Symbols of segments compared at once.
BLOCK = 1 << 20
REMOVED, BY_ANCHOR, BY_WINDOW = 0, 1, 2


@dataclass(frozen=True)
class Scheme:
    window: int
    gram: int
    words: bool
    sources: bool = False


#: Columns that ``apply`` adds.
RESULTS = ("n_symbols", "n_removed", "spans", "kept_sha256", "kept", "factors")
#: Where a mark's first window was found: document and place.
SOURCE = ("odoc", "oplace")

#: resolve(symbols, first symbol of each segment and the end, document of each segment, window)
#: gives a flag per symbol position: the window there starts in a smaller document; with
#: ``sources`` the position where it does, or -1.
Resolve = Callable[[np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]


def cuts_of(buf: np.ndarray) -> list[int]:
    """Places at white space that cut a buffer into steps."""
    cuts, at = [0], 0
    while len(buf) - at > TEXT_STEP:
        space = np.flatnonzero(IS_SPACE[buf[at + TEXT_STEP : at + 2 * TEXT_STEP]])
        at += TEXT_STEP + (int(space[0]) if len(space) else len(buf) - at - TEXT_STEP)
        cuts.append(at)
    return cuts + [len(buf)] if cuts[-1] < len(buf) else cuts


def word_bytes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, start and end of a buffer's words, step by step."""
    cuts = cuts_of(buf)
    parts = [word_codes(buf[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate([p[i] + (np.uint64(0) if i == 0 else a) for p, a in zip(parts, cuts)]) for i in range(3))


def symbols(raw: list[bytes], words: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts end to end, and each text's first and end."""
    lengths = np.array([len(x) + 1 for x in raw], np.int64)
    begin = np.cumsum(lengths) - lengths
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    if not words:
        return buf, begin, begin + lengths - 1
    codes, start, _ = word_bytes(buf)
    return codes, np.searchsorted(start, begin), np.searchsorted(start, begin + lengths - 1)


def _codes(part: np.ndarray, words: bool) -> np.ndarray:
    return part if words else BYTE_CODE[part]


def segments(held: np.ndarray, begin: np.ndarray, end: np.ndarray, scheme: Scheme):
    """Anchor, hash, text, first window and number of windows of every segment, in steps."""
    size = scheme.window
    for a in range(0, max(0, len(held) - size + 1), SYMBOL_STEP):
        codes = _codes(held[a : a + SYMBOL_STEP + size - 1], scheme.words)
        hashes = gram_hash(codes, scheme.gram)
        at = sliding_argmin(hashes, size - scheme.gram + 1)
        # texts that meet this step, and the last window of each
        t0, t1 = np.searchsorted(begin, [a, a + len(at) - 1], side="right") - 1
        near = np.arange(t0, t1 + 1)
        edges = np.clip(np.append(begin[t0 : t1 + 1], a + len(at)) - a, 0, len(at))
        text = np.repeat(near, np.diff(edges))
        at[np.repeat(end[near] - size - a, np.diff(edges)) < np.arange(len(at))] = -1
        first = np.flatnonzero(np.diff(at, prepend=-2) != 0)
        count = np.diff(np.append(first, len(at)))
        inside = at[first] >= 0
        first, count = first[inside], count[inside]
        yield hashes[at[first]], range_hash(prefix_sums(codes), first, first + count + size - 1), text[first], first + a - begin[text[first]], count


def _place(first, count):
    return (np.asarray(first, np.int64) << 8) | np.asarray(count, np.int64)


def _spread(doc, tag, place):
    """A key of its own for a row that meets no other."""
    return mix(mix(doc.view(np.uint64)) ^ tag.view(np.uint64) ^ place.view(np.uint64))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(id_or_last().alias("doc"), F.xxhash64("text").alias("tag"), "text")


def _raw(block: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in block.column("text").cast(pa.binary()).to_pylist()]


def _settled(key: np.ndarray, seg: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, where groups of equal (key, segment) start, which rows a smaller document settles, and the row of its group that does."""
    order = np.argsort(key)
    k = key[order]
    same = np.append(False, k[1:] == k[:-1])
    several = np.flatnonzero(same | np.append(same[1:], False))
    order[several] = order[several][np.lexsort((doc[order[several]], seg[order[several]], k[several]))]
    s, d = seg[order], doc[order]
    fresh = ~same | np.append(True, s[1:] != s[:-1])
    head = np.maximum.accumulate(np.where(fresh, np.arange(len(d)), 0)) if len(d) else np.zeros(0, np.int64)
    return order, fresh, d > d[head], head


def _gathered(held: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """Binary values: the symbols of each range, without a Python object per range."""
    ends = np.concatenate([[0], np.cumsum(length)])
    data = held[np.repeat(start - ends[:-1], length) + np.arange(ends[-1])]
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer((ends * held.itemsize).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _anchors(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """One row per segment; ``state`` 1: its anchor is crowded, 2: settled within the task."""

    def combined(rows: list[tuple]):
        key, seg, doc, tag, place = (np.concatenate(x) for x in zip(*rows))
        order, fresh, settled, head = _settled(key, seg, doc)
        key, seg, doc, tag, place = key[order], seg[order], doc[order], tag[order], place[order]
        anchor = np.cumsum(np.append(True, key[1:] != key[:-1])[: len(key)]) - 1 if len(key) else np.zeros(0, int)
        crowded = (np.bincount(anchor, weights=fresh) > CROWD)[anchor]
        marks = np.unique(key[crowded])
        state = np.where(settled, 2, crowded.astype(np.int64))
        key = np.where(settled, _spread(doc, tag, place), np.where(crowded, mix(key ^ seg), key))
        key = np.concatenate([key, marks]).view(np.int64)
        none, n = np.zeros(len(marks), np.int64), len(marks)
        source = [pa.array(np.concatenate([x[head], none]), mask=np.append(~settled, none == 0)) for x in (doc, place)] if scheme.sources else []
        yield pa.record_batch(
            [pa.array(key), pa.array(np.concatenate([seg.view(np.int64), none])), pa.array(np.concatenate([doc, none]), mask=np.arange(len(key)) >= len(key) - n),
             pa.array(np.concatenate([tag, none])), pa.array(np.concatenate([place, none])), pa.array(np.concatenate([state, none + 1]).astype(np.int32)), *source],
            names=["key", "seg", "doc", "tag", "place", "state", *SOURCE[: len(source)]])

    def scan(batches):
        rows, held = [], 0
        for block in text_blocks(batches, TEXT_STEP):
            raw = _raw(block)
            ids, tags = block.column("doc").to_numpy(), block.column("tag").to_numpy()
            for anchor, seg, text, first, count in segments(*symbols(raw, scheme.words), scheme):
                rows.append((anchor, seg, ids[text], tags[text], _place(first, count)))
                held += len(anchor)
            if held >= ROW_STEP:
                yield from combined(rows)
                rows, held = [], 0
        if held:
            yield from combined(rows)

    return _rows(docs).mapInArrow(scan, "key long, seg long, doc long, tag long, place long, state int" + (", odoc long, oplace long" if scheme.sources else ""))


def _marks(anchors: DataFrame) -> DataFrame:
    """Segments that are removed as a whole, and those to be compared window by window."""
    by_key, by_seg = Window.partitionBy("key"), Window.partitionBy("key", "seg")
    anchors = anchors.repartition("key").sortWithinPartitions("key", "seg")  # serves both windows
    seen = anchors.withColumns({
        "low": F.min("doc").over(by_key), "high": F.max("doc").over(by_key), "crowded": F.max(F.col("state") % 2).over(by_key),
        "seg_low": F.min(F.when(F.col("state") == 0, F.col("seg"))).over(by_key), "seg_high": F.max(F.when(F.col("state") == 0, F.col("seg"))).over(by_key),
        "rows": F.count("*").over(by_key)})
    found = ()
    if "odoc" in anchors.columns:
        seen = seen.withColumn("first", F.min(F.when(F.col("doc").isNotNull(), F.struct("doc", "place"))).over(by_seg)).withColumn("owner", F.col("first.doc"))
        found = tuple(F.coalesce(c, F.when(F.col("doc") > F.col("owner"), F.col(f"first.{c[1:]}"))).alias(c) for c in SOURCE)
    else:
        seen = seen.withColumn("owner", F.min("doc").over(by_seg))
    alone = (F.col("low") == F.col("high")) | (F.col("seg_low") == F.col("seg_high"))
    kind = (
        F.when(F.col("state") == 2, REMOVED).when(F.col("doc") > F.col("owner"), REMOVED)
        .when(F.col("crowded") == 1, BY_WINDOW).when(alone, None)
        .when(F.col("rows") > SPLIT, BY_WINDOW).otherwise(BY_ANCHOR)
    )
    return seen.where("doc is not null").withColumn("kind", kind).where("kind is not null").select("doc", "tag", "place", "key", "kind", *found)


def _compared(docs: DataFrame, marks: DataFrame, scheme: Scheme, resolve: Resolve) -> DataFrame:
    """(doc, tag, place) of what ``resolve`` finds removed among the undecided segments, with sources if the scheme has them."""
    size = scheme.window
    open_ = marks.where(F.col("kind") > 0).groupBy("doc", "tag").agg(F.collect_set(F.struct("place", "key", "kind")).alias("open"))
    texts = _rows(docs).join(open_, ["doc", "tag"])
    extra = [(c, pa.int64()) for c in SOURCE] if scheme.sources else []
    schema = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("place", pa.int64()), ("held", pa.binary()), *extra])

    def unknown(n: int) -> list[pa.Array]:
        return [pa.nulls(n, pa.int64()) for _ in extra]

    def cut(batches):
        for block in text_blocks(batches, TEXT_STEP):
            raw = _raw(block)
            held, begin, _ = symbols(raw, scheme.words)
            lists = block.column("open")
            row = np.repeat(np.arange(len(raw)), lists.value_lengths().to_numpy())
            place, key, kind = (lists.flatten().field(n).to_numpy(zero_copy_only=False) for n in ("place", "key", "kind"))
            doc, tag = (block.column(n).to_numpy()[row] for n in ("doc", "tag"))
            start, count = begin[row] + (place >> 8), place & 0xFF
            whole = kind == BY_ANCHOR
            for a in range(0, int(whole.sum()), ROW_STEP // 16):
                some = np.flatnonzero(whole)[a : a + ROW_STEP // 16]
                yield pa.record_batch([pa.array(key[some]), pa.array(doc[some]), pa.array(tag[some]), pa.array(place[some]), _gathered(held, start[some], count[some] + size - 1), *unknown(len(some))], schema=schema)
            # one row per window; repeats within the block are settled here
            apart = np.flatnonzero(~whole)
            if not len(apart):
                continue
            n = count[apart]
            of = np.repeat(apart, n)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at, doc, tag = start[of] + step, doc[of], tag[of]
            where = _place((place[of] >> 8) + step, 1)
            for a in range(0, len(at), ROW_STEP // 4):
                part = slice(a, a + ROW_STEP // 4)
                yield from single(held, at[part], doc[part], tag[part], where[part])

    def single(held, at, doc, tag, where):
        sums = prefix_sums(_codes(held, scheme.words))
        key = range_hash(sums, at, at + size)
        order, _, done, head = _settled(key, np.zeros(len(key), np.uint64), doc)
        by = order[head[done]]
        source = [pa.array(doc[by]), pa.array(where[by])] if scheme.sources else []
        gone, rest = order[done], order[~done]
        spread = _spread(doc[gone], tag[gone], where[gone]).view(np.int64)
        yield pa.record_batch([pa.array(spread), pa.array(doc[gone]), pa.array(tag[gone]), pa.array(where[gone]), pa.nulls(len(gone), pa.binary()), *source], schema=schema)
        yield pa.record_batch([pa.array(key[rest].view(np.int64)), pa.array(doc[rest]), pa.array(tag[rest]), pa.array(where[rest]), _gathered(held, at[rest], np.full(len(rest), size)), *unknown(len(rest))], schema=schema)

    def settle(rows: list[pa.RecordBatch]):
        table = pa.Table.from_batches(rows).combine_chunks()
        done = table.column("held").is_null().to_numpy(zero_copy_only=False)
        doc, tag, place = (table.column(n).to_numpy() for n in ("doc", "tag", "place"))
        out = [(doc[done], tag[done], place[done], *(table.column(c).fill_null(0).to_numpy()[done] for c, _ in extra))]
        if not done.all():
            doc, tag, place = doc[~done], tag[~done], place[~done]
            parts = table.column("held").combine_chunks().drop_null()
            parts = parts.chunk(0) if isinstance(parts, pa.ChunkedArray) else parts
            width = 8 if scheme.words else 1
            offsets = np.frombuffer(parts.buffers()[1], np.int32)[parts.offset : parts.offset + len(parts) + 1].astype(np.int64)
            held = np.frombuffer(parts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view(np.uint64 if scheme.words else np.uint8)
            first = (offsets - offsets[0]) // width
            resolved = resolve(held, first, doc, size)
            removed = np.append(resolved >= 0 if extra else resolved, False)
            removed[first[1:] - 1] = False
            edge = np.diff(removed.astype(np.int8), prepend=0)
            if extra:  # a run goes on only where its source does
                goes_on = np.append(False, resolved[1:] == resolved[:-1] + 1)
                own = np.flatnonzero(removed)
                begins = own[np.append(True, (own[1:] != own[:-1] + 1) | ~goes_on[own[1:]])[: len(own)]]
                start, count = begins, np.diff(np.append(np.searchsorted(own, begins), len(own)))
            else:
                start = np.flatnonzero(edge == 1)
                count = np.flatnonzero(edge == -1) - start
            seg = np.searchsorted(first, start, side="right") - 1
            found = [doc[seg], tag[seg], _place((place[seg] >> 8) + start - first[seg], count)]
            if extra:
                by = np.searchsorted(first, resolved[start], side="right") - 1
                found += [doc[by], _place((place[by] >> 8) + resolved[start] - first[by], count)]
            out.append(tuple(found))
        yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out)], names=["doc", "tag", "place", *(c for c, _ in extra)])

    def meet(batches):
        rows, held = [], 0
        for batch in batches:  # ordered by key, so a block ends between two keys
            if not batch.num_rows:
                continue
            if held > BLOCK:
                last, key = rows[-1].column("key")[-1].as_py(), batch.column("key").to_numpy()
                same = int((key == last).sum()) if key[0] == last else 0
                rows.append(batch.slice(0, same))
                if same < batch.num_rows:
                    yield from settle(rows)
                    rows, held, batch = [], 0, batch.slice(same)
                else:
                    continue
            rows.append(batch)
            held += batch.column("held").nbytes // (8 if scheme.words else 1)
        if rows:
            yield from settle(rows)

    more = "".join(f", {c} long" for c, _ in extra)
    cuts = texts.mapInArrow(cut, "key long, doc long, tag long, place long, held binary" + more)
    return cuts.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "doc long, tag long, place long" + more)


def repeated(docs: DataFrame, scheme: Scheme, resolve: Resolve) -> DataFrame:
    """(doc, tag, places) of every window that also starts in a smaller document.

    ``doc`` is the id as in ``id_or_last``, ``tag`` the text's hash; ``apply`` puts the places back on the rows.
    """
    marks = stored(_marks(_anchors(docs, scheme)), "marks")
    found = stored(_compared(docs, marks, scheme, resolve), "compared")
    mark = ["place", *SOURCE] if scheme.sources else ["place"]
    removed = marks.where(F.col("kind") == REMOVED).select("doc", "tag", *mark).union(found)
    return removed.groupBy("doc", "tag").agg(F.collect_set(F.struct(*mark) if scheme.sources else F.col("place")).alias("places"))


def _covered(places: np.ndarray, n: int, size: int) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    first, count = places >> 8, places & 0xFF
    np.add.at(step, first, 1)
    np.add.at(step, first + count + size - 1, -1)
    return np.cumsum(step)[:n] > 0


def factors(marks: pa.StructArray, size: int) -> np.ndarray:
    """Rows (start, end, reference document, start there): the greedy parse of what a text repeats.

    A factor goes on for as long as its reference does, through any number of marks; where it
    ends, the next window's own reference begins another one.
    """
    place, odoc, oplace = (marks.field(c).to_numpy(zero_copy_only=False) for c in ("place", *SOURCE))
    count = place & 0xFF
    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at, by, there = np.repeat(place >> 8, count) + step, np.repeat(odoc, count), np.repeat(oplace >> 8, count) + step
    order = np.lexsort((there, by, at))
    at, by, there = at[order], by[order], there[order]
    one = np.append(True, at[1:] != at[:-1])[: len(at)]
    at, by, there = at[one], by[one], there[one]
    new = np.append(True, (at[1:] != at[:-1] + 1) | (by[1:] != by[:-1]) | (there[1:] != there[:-1] + 1))[: len(at)]
    start = np.flatnonzero(new)
    end = at[np.append(start[1:], len(at)) - 1] + size if len(at) else at
    return np.stack([at[start], end, by[start], there[start]], axis=1)


def _gone(raw: bytes, own: pa.Scalar, scheme: Scheme):
    """Which symbols of a text are removed, the words' bounds, and the factors if the scheme has sources."""
    begin, end = (None, None)
    if scheme.words:
        _, begin, end = word_bytes(np.frombuffer(raw, np.uint8))
    n = len(begin) if scheme.words else len(raw)
    if not own.is_valid:
        return np.zeros(n, bool), (begin, end), np.zeros((0, 4), np.int64)
    if not scheme.sources:
        return _covered(own.values.to_numpy(zero_copy_only=False), n, scheme.window), (begin, end), None
    found = factors(own.values, scheme.window)
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, found[:, 0], 1)
    np.add.at(step, found[:, 1], -1)
    return np.cumsum(step)[:n] > 0, (begin, end), found


def _with_places(docs: DataFrame, places: DataFrame) -> DataFrame:
    places = places.select(F.col("doc").alias("__doc"), F.col("tag").alias("__tag"), F.col("places").alias("__places"))
    return docs.withColumns({"__doc": id_or_last(), "__tag": F.xxhash64("text")}).join(places, ["__doc", "__tag"], "left").select(*docs.columns, "__places")


def apply(docs: DataFrame, places: DataFrame, scheme: Scheme, kept: Callable[[bytes, np.ndarray, tuple], bytes], keep_text: bool) -> DataFrame:
    """``docs`` with n_symbols, n_removed, spans (start, end in symbols) and kept_sha256; with
    sources also ``factors`` (start, end, reference document, start there).

    ``keep_text``: also ``kept``, the remaining text as bytes. Columns of these names in the
    input give way.
    """
    docs = docs.select(*[c for c in docs.columns if c.lower() not in RESULTS])
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    schema = StructType([*docs.schema.fields, StructField("n_symbols", LongType()), StructField("n_removed", LongType()), StructField("spans", ArrayType(span)), StructField("kept_sha256", StringType())])
    if keep_text:
        schema = schema.add("kept", BinaryType())
    factor = StructType([StructField(c, LongType()) for c in ("start", "end", "reference", "there")])
    if scheme.sources:
        schema = schema.add("factors", ArrayType(factor))
    factors_type = pa.list_(pa.struct([(f.name, pa.int64()) for f in factor]))
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    names = docs.columns

    def measure(batches):
        for block in text_blocks(batches, TEXT_STEP):
            out = []
            for raw, own in zip(_raw(block), block.column("__places")):
                gone, bounds, parsed = _gone(raw, own, scheme)
                edge = np.diff(gone.astype(np.int8), prepend=0, append=0)
                spans = [{"start": a, "end": b} for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())]
                rest = kept(raw, gone, bounds)
                row = [len(gone), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()]
                row += [rest] if keep_text else []
                row += [[dict(zip(factor.names, f)) for f in parsed.tolist()]] if scheme.sources else []
                out.append(row)
            kinds = [pa.int64(), pa.int64(), spans_type, pa.string()] + [pa.binary()] * keep_text + [factors_type] * scheme.sources
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            yield pa.record_batch([block.column(c) for c in names] + columns, names=schema.names)

    return _with_places(docs, places).mapInArrow(measure, schema)


def cut_text(docs: DataFrame, places: DataFrame, scheme: Scheme, kept: Callable[[bytes, np.ndarray, tuple], bytes]) -> DataFrame:
    """``docs`` with ``text`` cut and ``n_chars`` set anew, without those left blank by a cut."""
    schema, names = docs.schema, docs.columns

    def cut(batches):
        for block in text_blocks(batches, TEXT_STEP):
            texts, stay = block.column("text").to_pylist(), []
            for i, (raw, own) in enumerate(zip(_raw(block), block.column("__places"))):
                gone, bounds, _ = _gone(raw, own, scheme)
                if gone.any():
                    texts[i] = kept(raw, gone, bounds).decode("utf-8", "ignore")
                stay.append(not gone.any() or bool(texts[i].strip()))
            new = {"text": pa.array(texts, block.schema.field("text").type)}
            if "n_chars" in names:
                n = pa.array([None if t is None else len(t) for t in texts], pa.int64())
                new["n_chars"] = n.cast(block.schema.field("n_chars").type, safe=False)
            columns = [new.get(c, block.column(c)) for c in names]
            yield pa.record_batch(columns, names=names).filter(pa.array(stay))

    return _with_places(docs, places).mapInArrow(cut, schema)
