"""Operator 7, embedding near-dedup: exact metric range join with pivots.

Vectors of one label link when their cosine is at least ``least``; on unit vectors that is a
range of r = sqrt(2 - 2 least) in Euclidean distance. A label of n distinct vectors gets about
sqrt(n) / 2 pivots (all labels together ``MOST_PIVOTS``, in proportion). Neighbouring pivots
share a cell of about ``BLOCK`` vectors; each vector's home is the cell of its nearest pivot. It
is copied to another cell only if it can lie within r of what is home to one of the cell's
pivots: by the triangle inequality its distance to that pivot may exceed that to its own by
2 r at most, and its distance to the plane between both pivots must be at most r. So every
partner of a vector comes to the vector's home, and cells are joined independently.

What is home in a cell and what is copied to it are cut into blocks along the distance to the
cell's first pivot; two blocks whose distances lie further apart than r are never brought
together, every other pair is a task, and a task compares the home of each pivot with what can
lie within r of it. A label that is too small for two pivots is one cell, with distances to a
fixed point.

Copies are made when they are dealt to their tasks and not kept: the cells are joined in waves,
so that the copies on disk stay within about ``COPIES`` times the distinct vectors, or those of one cell.

Equal vectors are one class with a weight, so copies are never paired; classes, not pairs, go
to the connected components. Vectors that are null, empty, zero or hold null or non-finite
components, and null labels, link with nothing; vectors of different lengths do not link;
rows that share an id count as separate vectors; a null id is larger than every other; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adoptlens.llm.components import components
from adoptlens.llm.hashing import mix
from adoptlens.llm.tables import NO_ID, discard, id_or_last, stored

#: Pivots of all labels together, 512 bytes each in 64 dimensions; vectors in a block, and their numbers' bytes at most.
MOST_PIVOTS, BLOCK, BLOCK_BYTES = 16_384, 32_768, 1 << 24
#: Copies in a wave of tasks, as a multiple of the distinct vectors, and the least that makes a wave.
COPIES, WAVE = 1.5, 1 << 17
#: Steps of a distance of 1 at which blocks are cut; vectors compared with a run of others at once, and the run.
RINGS, SOME, RUN = 32, 256, 8192
#: Room for rounding in the pruning, which may only keep too much.
ROOM = 1e-6


def _valid(vector: str):
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _point(size: int) -> np.ndarray:
    """A fixed point on the unit sphere for cells without a pivot."""
    return _unit(np.random.default_rng(size).normal(size=(1, size)))


def _classes(vectors: DataFrame) -> DataFrame:
    """(cls, label, size, vector, weight): distinct vectors; ``cls`` is their smallest id's row."""
    good = vectors.where("good")
    groups = good.groupBy("label", "vector").agg(F.count("*").alias("weight"), F.min("vec").alias("vec"))
    return groups.select("label", F.size("vector").alias("size"), "vector", "weight", "vec", F.xxhash64("label", "vector").alias("hash"))


def _pivots(classes: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Pivots of each label that gets two or more, picked by their hash."""
    counts = classes.groupBy("label", "size").agg(F.count("*").alias("n")).withColumn("k", F.floor(F.sqrt("n") / 2)).where("k > 1")
    total = counts.agg(F.sum("k")).first()[0] or 0
    counts = counts.withColumn("k", F.floor(F.col("k") * min(1.0, MOST_PIVOTS / max(1, total)))).where("k > 1")
    picked = F.pmod(F.xxhash64("hash"), F.col("n")) < F.col("k")  # k of n on average
    chosen = classes.join(counts, ["label", "size"]).where(picked).select("label", "size", "hash", "vector")
    found: dict[tuple[int, int], list] = {}
    for r in chosen.orderBy("label", "size", "hash").collect():
        found.setdefault((r.label, r.size), []).append(r.vector)
    return {k: _unit(np.array(v, np.float64)) for k, v in found.items() if len(v) > 1}


def _distances(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (x @ points.T)))


def _near(away: np.ndarray, home: np.ndarray, points: np.ndarray, radius: float) -> np.ndarray:
    """Which vectors can lie within ``radius`` of what is home to which point, by their distances and own point."""
    own = away[np.arange(len(away)), home][:, None]
    apart = _distances(points, points)[home]
    near = (away - own <= 2 * radius + ROOM) & (away**2 - own**2 <= 2 * radius * apart + ROOM)
    near[np.arange(len(away)), home] = True
    return near


def _parted(points: np.ndarray, parts: int) -> list[np.ndarray]:
    """Points in groups of neighbours, about equally many in each."""
    if parts <= 1 or len(points) <= 1:
        return [points]
    parts = min(parts, len(points))
    one = points[_distances(points[:1], points)[0].argmax()]
    other = points[_distances(one[None], points)[0].argmax()]
    points = points[np.argsort(points @ (one - other), kind="stable")]
    cut = len(points) * (parts // 2) // parts
    return _parted(points[:cut], parts // 2) + _parted(points[cut:], parts - parts // 2)


def _block_rows():
    """Vectors of a block, by the column ``size``."""
    return F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(BLOCK_BYTES / (8 * F.col("size"))))).cast("long")


def _shares(classes: DataFrame, pivots: dict) -> dict[tuple[int, int], list[np.ndarray]]:
    """The pivots of each cell of each label that has any."""
    counts = classes.groupBy("label", "size").agg(F.count("*").alias("n")).where(F.col("n") > _block_rows())
    parts = {(r.label, r.size): r.parts for r in counts.select("label", "size", F.ceil(F.col("n") / _block_rows()).alias("parts")).collect()}
    return {k: _parted(points, parts.get(k, 1)) for k, points in pivots.items()}


def _cells(classes: DataFrame, pivots: dict, radius: float, shares: dict | None = None, waves: int = 1, wave: int = 0) -> DataFrame:
    """A row per class and cell it comes to, with its distance to the cell's first pivot (``ring``); ``home``: its own cell.

    ``vector`` holds the numbers' bytes as they came. The cells of one wave of ``waves``.
    """
    shares = _shares(classes, pivots) if shares is None else shares
    shared = classes.sparkSession.sparkContext.broadcast(shares)  # about MOST_PIVOTS vectors at most
    kind = _kind(classes)
    schema = "label long, size int, hash long, weight long, cell int, home boolean, ring double, vector binary"

    def placed(x: np.ndarray, cells: list[np.ndarray] | None):
        """Row, cell, home and ring of every copy."""
        if cells is None:
            n = np.arange(len(x))
            return n, np.zeros(len(x), int), np.ones(len(x), bool), _distances(x, _point(x.shape[1]))[:, 0]
        points = np.concatenate(cells)
        starts = np.cumsum([0] + [len(c) for c in cells[:-1]])
        away = _distances(x, points)
        own = away.argmin(axis=1)
        home = np.searchsorted(starts, own, side="right") - 1
        row, cell = np.nonzero(np.logical_or.reduceat(_near(away, own, points, radius), starts, axis=1))
        return row, cell, home[row] == cell, away[row, starts[cell]]

    def place(batches):
        for batch in batches:
            labels, sizes = batch.column("label").to_numpy(), batch.column("size").to_numpy()
            starts = np.concatenate([[0], np.cumsum(sizes)])
            values = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
            for label, size in np.unique(np.stack([labels, sizes], axis=1), axis=0).tolist():
                own = np.flatnonzero((labels == label) & (sizes == size))
                for at in range(0, len(own), 1024):
                    some = own[at : at + 1024]
                    raw = values[starts[some][:, None] + np.arange(size)]
                    row, cell, home, ring = placed(_unit(raw.astype(np.float64)), shared.value.get((label, size)))
                    if waves > 1:
                        turn = mix(mix(np.array([label], np.int64).view(np.uint64) + np.uint64(size)) + cell.astype(np.uint64)) % np.uint64(waves) == wave
                        row, cell, home, ring = row[turn], cell[turn], home[turn], ring[turn]
                    columns = [batch.column(c).take(pa.array(some[row])) for c in ("label", "size", "hash", "weight")]
                    held = [raw[i].tobytes() for i in row.tolist()]
                    yield pa.record_batch([*columns, pa.array(cell.astype(np.int32)), pa.array(home), pa.array(ring), pa.array(held, pa.binary())],
                                          names=["label", "size", "hash", "weight", "cell", "home", "ring", "vector"])

    return classes.select("label", "size", "hash", "weight", F.col("vector").cast(f"array<{'float' if kind == np.float32 else 'double'}>").alias("vector")).mapInArrow(place, schema)


def _kind(classes: DataFrame) -> type:
    """Numbers of a vector's bytes: as they are stored if they are floats."""
    return np.float32 if dict(classes.dtypes)["vector"] == "array<float>" else np.float64


CELL = ["label", "size", "cell"]


def _rings(cells: DataFrame) -> DataFrame:
    """Per cell, home or not, and step of the ring: in which run of blocks its rows are (``run``), and how many blocks share them."""
    steps = cells.groupBy(*CELL, "home", F.floor(F.col("ring") * RINGS).alias("step")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*CELL, "home").orderBy("step")) - F.col("n")
    return steps.select(*CELL, "home", "step", F.floor(before / _block_rows()).alias("run"), F.ceil(F.col("n") / _block_rows()).alias("parts"))


def _blocks(cells: DataFrame, rings: DataFrame | None = None) -> DataFrame:
    """``cells`` with ``block``: about ``BLOCK`` rows of a cell that are neighbours by ``ring``, all home or all copies.

    A step of the ring that holds more is dealt by hash; the steps are a narrow table, so no vector moves.
    """
    rings = stored(_rings(cells), "vector-rings") if rings is None else rings
    stepped = cells.withColumn("step", F.floor(F.col("ring") * RINGS)).join(rings, [*CELL, "home", "step"])
    block = F.struct("home", "run", F.pmod("hash", "parts").alias("part"))
    return stepped.withColumn("block", block).drop("step", "run", "parts")


def _met(rows: DataFrame, radius: float) -> DataFrame:
    """(cell, mine, block, other, searches, n): the tasks that a block's rows (``n``) go to, as home rows or as others.

    A task is a block of home rows and a block of their cell whose ring comes within ``radius``.
    """
    blocks = rows.groupBy(*CELL, "block").agg(F.min("ring").alias("low"), F.max("ring").alias("high"), F.count("*").alias("n"))
    other = blocks.select(*CELL, F.col("block").alias("other"), F.col("low").alias("low2"), F.col("high").alias("high2"), F.col("n").alias("n2"))
    room = radius + ROOM
    pairs = blocks.where("block.home").join(other, CELL).where((F.col("low2") <= F.col("high") + room) & (F.col("high2") >= F.col("low") - room))
    role = F.explode(F.array(F.struct(F.col("block").alias("mine"), F.lit(True).alias("searches"), "n"), F.struct(F.col("other").alias("mine"), F.lit(False).alias("searches"), F.col("n2").alias("n"))))
    return pairs.select(*CELL, "block", "other", role.alias("role")).select(*CELL, "role.mine", "block", "other", "role.searches", "role.n")


def _tasks(rows: DataFrame, radius: float, met: DataFrame | None = None) -> DataFrame:
    """Every block's home rows with every block of their cell whose ring comes within ``radius``."""
    met = stored(_met(rows, radius), "vector-tasks") if met is None else met
    return rows.withColumnRenamed("block", "mine").join(met.drop("n"), [*CELL, "mine"]).select(*CELL, "block", "other", "searches", "hash", "weight", "vector")


def _waves(met: DataFrame, classes: DataFrame) -> int:
    """Waves of cells, each of about ``COPIES`` copies for each class."""
    copies = met.agg(F.sum("n")).first()[0] or 0
    return max(1, int(-(-copies // max(WAVE, COPIES * classes.count()))))


def _links(tasks: DataFrame, least: float, shares: dict, kind: type) -> DataFrame:
    """Per task: weight each home class links with (``n``), and a class it is connected to (``b``)."""
    radius = np.sqrt(max(0.0, 2 - 2 * least))
    shared = tasks.sparkSession.sparkContext.broadcast(shares)

    def joined(where: tuple[int, int, int], parts: list[pa.RecordBatch]) -> tuple[list, list, list]:
        label_of, size, cell = where
        table = pa.Table.from_batches(parts)
        searches = table["searches"].to_numpy()
        if searches.all() or not searches.any():
            return [], [], []
        raw = np.frombuffer(b"".join(table["vector"].to_pylist()), kind).reshape(-1, size)
        hashes, weights = table["hash"].to_numpy(), table["weight"].to_numpy()
        a, b, weight = hashes[searches], hashes[~searches], weights[~searches]
        x, y = raw[searches], raw[~searches]
        cells = shared.value.get((label_of, size))
        points = _point(size) if cells is None else cells[cell]
        # units as short floats find what may link; double numbers decide
        unit_x, unit_y = (np.concatenate([_unit(z[i : i + RUN].astype(np.float64)).astype(np.float32) for i in range(0, len(z), RUN)]) for z in (x, y))
        from_x, from_y = (np.concatenate([_distances(_unit(z[i : i + RUN].astype(np.float64)), points) for i in range(0, len(z), RUN)]) for z in (x, y))
        bar = np.float32(least - 1.2e-7 * size - 1e-5)
        home = from_x.argmin(axis=1)
        near = _near(from_y, from_y.argmin(axis=1), points, radius)
        n, label = np.zeros(len(a), np.int64), {}

        def root(k):
            while label.get(k, k) != k:
                label[k] = k = label.get(label[k], label[k])
            return k

        def linked(mine: np.ndarray, theirs: np.ndarray):
            """Links of some home vectors with some others, by their exact cosines."""
            p, q = x[mine].astype(np.float64), y[theirs].astype(np.float64)
            cosine = (p @ q.T) / (np.sqrt((p * p).sum(axis=1))[:, None] * np.sqrt((q * q).sum(axis=1))[None, :])
            hit = (cosine >= least) & (a[mine][:, None] != b[theirs][None, :])
            n[mine] += hit @ weight[theirs]
            for i in np.flatnonzero(hit.any(axis=1)):
                p = root(int(a[mine[i]]))
                for q in {root(int(k)) for k in b[theirs[hit[i]]]}:
                    p, q = min(p, root(q)), max(p, root(q))
                    label[q] = p

        for point in np.unique(home).tolist():
            # distances to the pivot differ by no more than the distance itself
            others = np.flatnonzero(near[:, point])
            others = others[np.argsort(from_y[others, point], kind="stable")]
            ring, run = from_y[others, point], unit_y[others]
            mine = np.flatnonzero(home == point)
            mine = mine[np.argsort(from_x[mine, point], kind="stable")]
            for at in range(0, len(mine), SOME):
                take = mine[at : at + SOME]
                low, high = np.searchsorted(ring, [from_x[take[0], point] - radius - ROOM, from_x[take[-1], point] + radius + ROOM])
                for i in range(low, high, RUN):
                    some = slice(i, min(i + RUN, high))
                    close = unit_x[take] @ run[some].T
                    rows = np.flatnonzero(close.max(axis=1) >= bar)
                    if len(rows):
                        linked(take[rows], others[some][(close[rows] >= bar).any(axis=0)])
        ends = set(a.tolist()) | set(label)
        star = [(k, root(k)) for k in ends if root(k) != k]
        out = [(int(h), int(c), None) for h, c in zip(a, n) if c] + [(k, 0, r) for k, r in star]
        return tuple(map(list, zip(*out))) if out else ([], [], [])

    def meet(batches):
        key, where, parts = None, None, []
        kinds = [pa.int64()] * 3

        def batch_of(found):
            return pa.record_batch([pa.array(c, k) for c, k in zip(found, kinds)], names=["a", "n", "b"])

        for batch in batches:
            tasks = batch.column("task").to_pylist()
            starts = [i for i, k in enumerate(tasks) if i == 0 or k != tasks[i - 1]]
            for i, j in zip(starts, [*starts[1:], batch.num_rows]):
                if tasks[i] != key:
                    if parts:
                        yield batch_of(joined(where, parts))
                    key, where, parts = tasks[i], tuple(batch.column(c)[i].as_py() for c in CELL), []
                parts.append(batch.slice(i, j - i).select(["searches", "hash", "weight", "vector"]))
        if parts:
            yield batch_of(joined(where, parts))

    name = F.concat_ws("/", *CELL, *(f"{block}.{part}" for block in ("block", "other") for part in ("home", "run", "part")))
    named = tasks.withColumn("task", name).select("task", *CELL, "searches", "hash", "weight", "vector")
    return named.repartition("task").sortWithinPartitions("task").mapInArrow(meet, "a long, n long, b long")


def join(embeddings: DataFrame, least: float = 0.98) -> DataFrame:
    """Per vector: vec (id as in ``id_or_last``), n_links, component."""
    vectors = embeddings.select(id_or_last("vec_id").alias("vec"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("vector"))
    vectors = vectors.withColumn("good", _valid("vector") & F.col("label").isNotNull())
    classes = stored(_classes(vectors), "vector-classes")
    radius = float(np.sqrt(max(0.0, 2 - 2 * least)))
    pivots = _pivots(classes)
    shares = _shares(classes, pivots)
    rings = stored(_rings(_cells(classes, pivots, radius, shares)), "vector-rings")
    met = stored(_met(_blocks(_cells(classes, pivots, radius, shares), rings), radius), "vector-tasks")
    waves = _waves(met, classes)

    def wave(k: int) -> DataFrame:
        rows = _blocks(_cells(classes, pivots, radius, shares, waves, k), rings)
        return stored(_links(_tasks(rows, radius, met), least, shares, _kind(classes)), "vector-links")

    found = reduce(DataFrame.union, [wave(k) for k in range(waves)])
    discard(rings, met)
    counts = found.groupBy("a").agg(F.sum("n").alias("n")).withColumnRenamed("a", "hash")
    joined = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "hash")
    heads = classes.select("hash", "weight", "vec").join(counts, "hash", "left").join(joined, "hash", "left")
    heads = heads.withColumn("component", F.coalesce("component", "hash"))
    least_id = heads.groupBy("component").agg(F.min("vec").alias("least"))
    heads = heads.join(least_id, "component").select("hash", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"), "least")
    rows = vectors.select("vec", F.when(F.col("good"), F.xxhash64("label", "vector")).alias("hash"))
    rows = rows.join(heads, "hash", "left")
    return rows.select("vec", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("least", "vec").alias("component"))


def shown(name: str):
    return F.when(F.col(name) != NO_ID, F.col(name))
