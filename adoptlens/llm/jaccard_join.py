"""Operator 8, n-gram Jaccard join with signature trees.

Documents link when the sets of their word shingles overlap by at least ``percent`` hundredths
of the union. The join is exact:

1. Documents of equal sets are one class. A class with enough shingles that no other class has
   (as many as the shortest prefix in which two similar sets must meet) links with nothing;
   that is found on the quarter of all shingles with the smallest hash, in one shuffle, and
   then, among the classes that are left, on all their shingles.
2. The other classes are grouped: two classes whose prefixes share a shingle fall into one
   cluster (connected components), so no link leaves a cluster. A large cluster is cut by size
   and hash into blocks of at most about ``BLOCK`` sets and ``WEIGHT`` shingles, and the pairs of blocks whose sizes fit become separate tasks.
   The tasks run in waves, so that the copies of the sets on disk stay within ``COPIES`` times the sets.
3. In each task, a tree over the sets holds, per node, the combined shingle bitmap (the most
   that any set below has per bit) and the range of sizes. A dual traversal drops pairs of
   nodes whose largest possible overlap is too small, skips those already connected, and
   verifies the rest set by set.

Empty and null texts have an empty set and link with nothing; copies link with each other;
repeated rows and rows that share an id are compared like any others; a null id counts as
larger than every other; an empty table gives no rows; further columns are ignored by
``classes`` and kept by ``keep_one``.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adoptlens.llm.components import components
from adoptlens.llm.hashing import LOWER, gram_hash, mix
from adoptlens.llm.repeats import TEXT_STEP, word_bytes
from adoptlens.llm.tables import NO_ID, discard, id_or_last, stored
from adoptlens.llm.tokens import text_blocks

#: Shingles with a hash below this are looked at first: a quarter.
REGION = np.uint64(1 << 62)
#: Prefixes take the rarest of the shingles with a hash below this first: of a half.
RANKED = np.uint64(1 << 63)
#: Sets of at most so many shingles show all of them first.
NARROW = 100
#: Sets in a block, and in a leaf of a tree; children of a node; bits of a node's bitmap.
BLOCK, LEAF, CHILDREN, BITS = 1024, 8, 8, 2048
#: Shingles in a block, 8 bytes each.
WEIGHT = 1 << 22
#: Shingles that the tasks of a wave hold, as a multiple of those of all sets, and the least that makes a wave.
COPIES, WAVE = 2, 1 << 23
#: Shingles whose holders are compared at once.
VERIFY = 1 << 20


def shingle_sets(raw: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, each text's in ascending order, and where each starts."""
    lengths = np.array([len(x) + 1 for x in raw], np.int64)
    buf = LOWER[np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)]
    begin = np.cumsum(lengths) - lengths
    codes, start, _ = word_bytes(buf)
    first = np.append(np.searchsorted(start, begin), len(codes))
    text = np.repeat(np.arange(len(raw)), np.diff(first))
    hashes = gram_hash(codes, size)
    at = np.arange(len(hashes))
    inside = at + size <= first[text[: len(hashes)] + 1]
    hashes, owner = hashes[inside], text[: len(hashes)][inside]
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < size))
    if len(short):
        whole = [mix(gram_hash(codes[first[i] : first[i + 1]], int(first[i + 1] - first[i])) + np.uint64(first[i + 1] - first[i])) for i in short]
        hashes, owner = np.concatenate([hashes, *whole]), np.concatenate([owner, short])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1]))[: len(hashes)]
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(len(raw) + 1))


def _signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One number per set, equal for equal sets; sizes are mixed in."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)])
    return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64)).view(np.int64)


def _raw(block: pa.RecordBatch) -> list[bytes]:
    return [x or b"" for x in block.column("text").cast(pa.binary()).to_pylist()]


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """doc, text hash, set signature (null: empty), set size, and shingles of the region (once a block and set)."""

    def scan(batches):
        for block in text_blocks(batches, TEXT_STEP):
            hashes, first = shingle_sets(_raw(block), size)
            sig, n = _signatures(hashes, first), np.diff(first)
            _, seen = np.unique(sig, return_index=True)
            take = np.zeros(len(sig), bool)
            take[seen] = True
            low = ((hashes < REGION) | np.repeat(n <= NARROW, n)) & np.repeat(take, n)
            offsets = np.concatenate([[0], np.cumsum(low)])[first]
            region = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes[low].view(np.int64)))
            yield pa.record_batch([block.column("doc"), block.column("text_hash"), pa.array(sig, mask=n == 0), pa.array(n, pa.int64()), region], names=["doc", "text_hash", "sig", "n", "region"])

    return docs.select(id_or_last().alias("doc"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(scan, "doc long, text_hash long, sig long, n long, region array<long>")


def _prefix(percent: int):
    """Length of the prefix in which two similar sets must share an element, by set size ``n``."""
    return F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1


def _undecided(sets: DataFrame, percent: int) -> DataFrame:
    """(sig, n, doc): classes that may link with another; ``doc`` is their smallest document."""
    # small sets show all their shingles; what others of similar size hold decides
    held = sets.where("sig is not null").select("sig", "n", F.explode("region").alias("shingle"))
    low = (F.col("shingle") >= 0) & (F.col("shingle") < int(REGION))
    small, large = F.col("n") <= NARROW, low & (F.col("n") > NARROW * percent // 100 * percent // 100)
    held = held.select("sig", "shingle", F.explode(F.filter(F.array(F.when(small, F.lit(0)), F.when(large, F.lit(1))), lambda x: x.isNotNull())).alias("side"), "n")
    holders = held.groupBy("shingle", "side").agg(F.min("sig").alias("sig"), F.max("sig").alias("other"), F.max("n").alias("n"))
    rightful = (F.col("side") == 0) == (F.col("n") <= NARROW * percent // 100)
    own = holders.where("sig = other").where(rightful).groupBy("sig").agg(F.count("*").alias("own"))
    classes = sets.where("sig is not null").groupBy("sig").agg(F.max("n").alias("n"), F.min("doc").alias("doc"))
    return classes.join(own, "sig", "left").where(F.coalesce("own", F.lit(0)) < _prefix(percent)).select("sig", "n", "doc")


def _full(docs: DataFrame, undecided: DataFrame, size: int) -> DataFrame:
    """(sig, n, shingles): the whole sets of the undecided classes, ascending."""

    def scan(batches):
        for block in text_blocks(batches, TEXT_STEP):
            hashes, first = shingle_sets(_raw(block), size)
            right = _signatures(hashes, first) == block.column("sig").to_numpy()
            held = [hashes[first[i] : first[i + 1]].tobytes() for i in np.flatnonzero(right)]
            mask = pa.array(right)
            yield pa.record_batch([block.column("sig").filter(mask), block.column("n").filter(mask), pa.array(held, pa.binary())], names=["sig", "n", "shingles"])

    # a merge join at every size: the undecided classes grow with the documents
    texts = docs.select(id_or_last().alias("doc"), "text").join(undecided.hint("merge"), "doc").select("sig", "n", "text")
    return texts.mapInArrow(scan, "sig long, n long, shingles binary")


def _slices(undecided: DataFrame, sets: DataFrame) -> int:
    """Slices in which no more shingles of the undecided classes are looked at than a quarter of all."""
    some, every = undecided.agg(F.sum("n")).first()[0] or 0, sets.agg(F.sum("n")).first()[0] or 1
    return max(1, -(-4 * some // every))


def _shared(full: DataFrame, percent: int, slices: int) -> DataFrame:
    """``full``, once a class, without those of which others in it hold too few shingles for a link."""

    def held(k: int):
        def scan(batches):
            for batch in batches:
                sets = [np.frombuffer(x, np.uint64) for x in batch.column("shingles").to_pylist()]
                sets = [h[(h >> np.uint64(32)) % np.uint64(slices) == k] for h in sets] if slices > 1 else sets
                if sets:
                    sig = np.repeat(batch.column("sig").to_numpy(), [len(h) for h in sets])
                    yield pa.record_batch([pa.array(sig), pa.array(np.concatenate(sets).view(np.int64))], names=["sig", "shingle"])

        rows = full.select("sig", "shingles").mapInArrow(scan, "sig long, shingle long")
        holders = rows.groupBy("shingle").agg(F.min("sig").alias("sig"), F.max("sig").alias("other"))
        return stored(holders.where("sig = other").groupBy("sig").agg(F.count("*").alias("own")), "own-shingles")

    # slice by slice, each freed before the next
    parts = [held(k) for k in range(slices)]
    own = reduce(DataFrame.union, parts).groupBy("sig").agg(F.sum("own").alias("own"))
    left = full.join(own, "sig", "left").where(F.coalesce("own", F.lit(0)) < _prefix(percent))
    left = stored(left.select("sig", "n", "shingles").dropDuplicates(["sig"]), "shared-sets")
    discard(*parts)
    return left


def _candidates(full: DataFrame, percent: int) -> DataFrame:
    """Shingles that a prefix may hold: all below ``RANKED`` and, for small sets, the next ones.

    ``wanted``: length of the prefix; ``place``: order by hash.
    """

    def cut(batches):
        for batch in batches:
            n = batch.column("n").to_numpy()
            wanted = n - -(-n * percent // 100) + 1
            held = [np.frombuffer(x, np.uint64) for x in batch.column("shingles").to_pylist()]
            length = [max(k, int(np.searchsorted(h, RANKED))) for h, k in zip(held, wanted.tolist())]
            if held:
                shingle = np.concatenate([h[:k] for h, k in zip(held, length)])
                place = np.concatenate([np.arange(k) for k in length]).astype(np.int32)
                yield pa.record_batch(
                    [pa.array(np.repeat(batch.column("sig").to_numpy(), length)), pa.array(np.repeat(wanted, length)), pa.array(place), pa.array(shingle < RANKED), pa.array(shingle.view(np.int64))],
                    names=["sig", "wanted", "place", "inside", "shingle"])

    return full.mapInArrow(cut, "sig long, wanted long, place int, inside boolean, shingle long")


def _clusters(full: DataFrame, percent: int) -> DataFrame:
    """(sig, cluster) of the classes that share a prefix shingle with another.

    Prefixes take the rarest shingles below ``RANKED`` first, then the others by hash: one order
    for all sets, in which passages that many documents hold come late.
    """
    rows = stored(_candidates(full, percent), "prefix-candidates")
    often = rows.where("inside").groupBy("shingle").agg(F.count("*").alias("often"))
    order = Window.partitionBy("sig").orderBy(F.coalesce("often", F.lit(NO_ID)), "place")
    ranked = rows.join(often, "shingle", "left").withColumn("rank", F.row_number().over(order))
    prefixes = stored(ranked.where("rank <= wanted and (often is null or often > 1)").select("sig", "shingle"), "prefixes")
    shared = prefixes.groupBy("shingle").agg(F.min("sig").alias("low"), F.max("sig").alias("high")).where("low <> high").select("shingle", "low")
    links = prefixes.join(shared, "shingle").select(F.col("sig").alias("a"), F.col("low").alias("b"))
    clusters = components(links).select(F.col("node").alias("sig"), F.col("component").alias("cluster"))
    discard(rows, prefixes)
    return clusters


def _placed(full: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """Sets with their place in a cluster: ``me`` (band and block), and the blocks of their band and both neighbours.

    Sizes that may link lie in one band or the next. No ``near``: few sets in all, one task.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + F.lit(1e-9)).cast("int")
    members = full.select("sig", band.alias("band"), "n").join(clusters, "sig")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / WEIGHT)).cast("int")
    counts = members.groupBy("cluster", "band").agg(blocks.alias("blocks"))
    members = members.drop("n")
    whole = counts.groupBy("cluster").agg(F.sum(F.when(F.col("blocks") == 1, 0).otherwise(1)).alias("large"), F.count("*").alias("bands"), F.map_from_entries(F.collect_list(F.struct("band", "blocks"))).alias("of"))
    small = (F.col("large") == 0) & (F.col("bands") <= 4)

    def blocks_of(shift: int):
        return F.coalesce(F.try_element_at("of", F.col("band") + shift), F.lit(0))

    own = F.pmod(F.xxhash64("sig"), F.greatest(blocks_of(0), F.lit(1))).cast("int")
    members = members.join(whole, "cluster").select(
        "sig", "cluster", F.when(small, _name(F.lit(0), F.lit(0))).otherwise(_name(F.col("band"), own)).alias("me"),
        F.when(~small, F.array(blocks_of(-1), blocks_of(0), blocks_of(1))).alias("near"))
    # the sets themselves move once to their place in a cluster, and once to their tasks
    return full.join(members.hint("merge"), "sig").select("cluster", "me", "near", "sig", "n", "shingles")


def _name(band, block):
    return F.struct(band.alias("band"), block.alias("block"))


def _waves(placed: DataFrame) -> int:
    """Waves of tasks, each of at most about ``COPIES`` times the sets' shingles."""
    copies = F.coalesce(F.aggregate("near", F.lit(0), lambda a, x: a + x), F.lit(1)).cast("long")
    once, moved = placed.agg(F.sum("n"), F.sum(F.col("n") * copies)).first()
    return max(1, -(-(moved or 0) // max(WAVE, COPIES * (once or 0))))


def _tasks(placed: DataFrame, waves: int = 1, wave: int = 0) -> DataFrame:
    """Sets by task of a wave: a cluster's pair of blocks. Each block meets its band's and both neighbours' blocks."""
    me = F.col("me")

    def meets(shift: int):
        blocks = F.element_at("near", shift + 2)
        blocks = F.when(blocks > 0, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(blocks, lambda k: _name(me["band"] + shift, k))

    partners = F.when(F.col("near").isNull(), F.array(me)).otherwise(F.concat(meets(-1), meets(0), meets(1)))
    if waves > 1:  # before the copies are made
        partners = F.filter(partners, lambda x: F.pmod(F.xxhash64("cluster", F.least(me, x), F.greatest(me, x)), F.lit(waves)) == wave)
    sets = placed.select("cluster", "sig", "n", "shingles", "me", F.explode(partners).alias("partner"))
    return sets.withColumns({"low": F.least("me", "partner"), "high": F.greatest("me", "partner")}).select("cluster", "low", "high", (F.col("me") == F.col("low")).alias("left"), "sig", "n", "shingles")


def _bitmap(held: np.ndarray) -> np.ndarray:
    """Elements per bit, whole: a clipped count would bound overlaps too low. As narrow as the largest allows."""
    counts = np.bincount((held % np.uint64(BITS)).astype(np.int64), minlength=BITS)
    return counts.astype(np.min_scalar_type(int(counts.max())))


class Tree:
    """Sets in order of size and smallest element; each level's nodes span ``CHILDREN`` below."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), int(sets[i][0])))
        counts = [_bitmap(sets[i]) for i in self.order]
        sizes = np.array([len(sets[i]) for i in self.order])
        starts = np.arange(0, len(sets), LEAF)
        bits = np.stack(counts)
        self.levels = [(starts, np.append(starts[1:], len(sets)), np.maximum.reduceat(bits, starts), np.minimum.reduceat(sizes, starts), np.maximum.reduceat(sizes, starts))]
        while len(starts) > 1:
            _, end, bits, low, high = self.levels[-1]
            heads = np.arange(0, len(starts), CHILDREN)
            starts, end = starts[heads], np.append(starts[heads][1:], len(sets))
            self.levels.append((starts, end, np.maximum.reduceat(bits, heads), np.minimum.reduceat(low, heads), np.maximum.reduceat(high, heads)))


def _verified(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> np.ndarray:
    """Which pairs of sets of two leaves link, by their exact overlap, counted in steps."""
    every, at = np.unique(np.concatenate(a + b), return_inverse=True)
    sizes = np.array([len(x) for x in a + b])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    both = np.zeros((len(a), len(b)), np.int64)
    for start in range(0, len(every), VERIFY):
        inside = (at >= start) & (at < start + VERIFY)
        member = np.zeros((len(sizes), min(VERIFY, len(every) - start)), np.float32)
        member[owner[inside], at[inside] - start] = 1
        both += np.rint(member[: len(a)] @ member[len(a) :].T).astype(np.int64)
    union = sizes[: len(a), None] + sizes[None, len(a) :] - both
    return 100 * both >= percent * union


def linked(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """Label per set (left, then right): equal for sets that links connect.

    ``right`` None: all pairs within ``left``; else the pairs between the two sides.
    """
    a = Tree(left)
    b = a if right is None else Tree(right)
    shift = 0 if right is None else len(left)
    every = left if right is None else left + right
    label = np.arange(len(every))
    of_a, of_b = np.array(a.order), np.array(b.order) + shift
    todo = [(len(a.levels) - 1, 0, len(b.levels) - 1, 0)]
    while todo:
        la, i, lb, j = todo.pop()
        a0, a1, bits_a, low_a, high_a = (x[i] for x in a.levels[la])
        b0, b1, bits_b, low_b, high_b = (x[j] for x in b.levels[lb])
        if right is None and (b1 <= a0):
            continue  # the mirrored pair is looked at
        most = min(int(high_a), int(high_b), int(np.minimum(bits_a, bits_b).sum()))
        if (100 + percent) * most < percent * (int(low_a) + int(low_b)):
            continue
        ours, theirs = of_a[a0:a1], of_b[b0:b1]
        known = label[ours[0]]
        if (label[ours] == known).all() and (label[theirs] == known).all():
            continue
        if la == 0 and lb == 0:
            for x, y in zip(*np.nonzero(_verified([every[k] for k in ours], [every[k] for k in theirs], percent))):
                p, q = label[ours[x]], label[theirs[y]]
                if p != q:
                    label[label == max(p, q)] = min(p, q)
        elif la >= lb:
            todo += [(la - 1, k, lb, j) for k in range(i * CHILDREN, min((i + 1) * CHILDREN, len(a.levels[la - 1][0])))]
        else:
            todo += [(la, i, lb - 1, k) for k in range(j * CHILDREN, min((j + 1) * CHILDREN, len(b.levels[lb - 1][0])))]
    return label


def _links(tasks: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that connect what each task found connected."""
    by = ["cluster", "low", "high"]

    def found(rows: list[tuple]):
        rows = list({(sig, left): (sig, left, held) for sig, left, held in rows}.values())
        ours = [(s, h) for s, left, h in rows if left]
        others = [(s, h) for s, left, h in rows if not left]
        if len(ours) + len(others) < 2 or not ours:
            return [], []
        sig = np.array([s for s, _ in ours + others], np.int64)
        label = linked([h for _, h in ours], [h for _, h in others] or None, percent)
        away = np.flatnonzero(label != np.arange(len(label)))
        return sig[away].tolist(), sig[label[away]].tolist()

    def meet(batches):
        key, rows = None, []
        for batch in batches:
            a, b = [], []
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("task", "cluster"))))
            for k, sig, left, held in zip(keys, batch.column("sig").to_pylist(), batch.column("left").to_pylist(), batch.column("shingles").to_pylist()):
                if k != key:
                    x, y = found(rows)
                    a += x
                    b += y
                    key, rows = k, []
                rows.append((sig, left, np.frombuffer(held, np.uint64)))
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        a, b = found(rows)
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    named = tasks.withColumn("task", F.concat_ws("/", F.col("low.band"), F.col("low.block"), F.col("high.band"), F.col("high.block"))).drop("low", "high")
    return named.repartition("cluster", "task").sortWithinPartitions("cluster", "task").mapInArrow(meet, "a long, b long")


def classes(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """Per row of ``docs``: doc, text_hash, n, sig, component (smallest document reachable).

    ``doc`` and ``component`` as in ``id_or_last``.
    """
    shown = stored(_sets(docs, size), "shingle-sets")
    undecided = stored(_undecided(shown, percent), "undecided")
    sets = stored(shown.drop("region"), "sets")
    discard(shown)
    every = stored(_full(docs, undecided, size), "full-sets")
    full = _shared(every, percent, _slices(undecided, sets))
    discard(every)
    clusters = stored(_clusters(full, percent), "clusters")
    placed = stored(_placed(full, clusters, percent), "placed-sets")
    discard(full, clusters)
    waves = _waves(placed)
    links = [stored(_links(_tasks(placed, waves, k), percent), "set-links") for k in range(waves)]
    discard(placed)
    joined = components(reduce(DataFrame.union, links))
    discard(*links)
    heads = joined.join(undecided.withColumnRenamed("sig", "node"), "node").select("node", "component", "doc")
    least = heads.groupBy("component").agg(F.min("doc").alias("least"))
    heads = heads.select("node", "component").join(least, "component").select(F.col("node").alias("sig"), "least")
    smallest = sets.where("sig is not null").groupBy("sig").agg(F.min("doc").alias("first")).join(heads, "sig", "left").select("sig", F.coalesce("least", "first").alias("component"))
    rows = sets.select("doc", "text_hash", "n", "sig").join(smallest, "sig", "left")
    return rows.withColumn("component", F.coalesce("component", "doc"))


def keep_one(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id.

    Rows without an id give way to rows with one; repeated rows are kept once.
    """
    kept = classes(docs, size, percent).where("doc = component").select(F.col("doc").alias("_doc"), F.col("text_hash").alias("_hash")).distinct()
    rows = docs.withColumns({"_doc": id_or_last(), "_hash": F.xxhash64("text")})
    return rows.join(kept, ["_doc", "_hash"]).dropDuplicates(["_doc", "_hash"]).select(*docs.columns)


def visible_id(name: str):
    return F.when(F.col(name) != NO_ID, F.col(name))
