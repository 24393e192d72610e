"""Operator 5, quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Each passage is encoded (shares of
signs, repetition, hashed words, then a learned layer); gated attention, learned from the
documents' labels alone, weighs the passages; the weighted representation is scored.

Training uses at most ``sample`` labelled documents, those with the smallest hash of their id,
as long as all their passages together are at most ``passages`` (a document that would exceed
them is passed over), and reads every passage of theirs; scoring reads every passage of every
text. A score depends on its text alone: sums run in an order of their own, whatever else is in
the batch. Null and empty texts are a bag of one empty passage. Every row is scored by itself,
repeated rows and null ids too; rows of ``labels`` with a null or other label are left out;
without labels of both kinds every score is 0.5; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adoptlens.llm.hashing import word_codes
from adoptlens.llm.repeats import cuts_of
from adoptlens.llm.tables import discard, stored
from adoptlens.llm.tokens import text_blocks

PASSAGE, HASHED = 64, 64
HIDDEN, GATE = 24, 12
FOLDS = 5
#: Characters that a task encodes at once; passages that are multiplied at once.
STEP, ROWS = 1 << 20, 4096


def _class(chars: str) -> np.ndarray:
    table = np.zeros(256, np.float32)
    table[list(chars.encode())] = 1
    return table


_BYTE_KINDS = [
    _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789"), _class("!?"), _class(".,;:'\"()-"),
    _class("#$%&*+/<=>@[\\]^_`{|}~"), np.r_[np.zeros(128, np.float32), np.ones(128, np.float32)],
]
#: Kinds, sign-only words, words with other signs, capital words, repeats at three distances, length, words.
FEATURES = len(_BYTE_KINDS) + 8 + HASHED


def _words(buf: np.ndarray):
    """Hash, start, length and signs of each kind of every word, a step of the buffer at a time."""
    codes, starts, widths, kinds = [], [], [], [[] for _ in _BYTE_KINDS]
    cuts = cuts_of(buf)
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = buf[a:b]
        code, start, end = word_codes(part)
        codes.append(code)
        starts.append(start + a)
        widths.append((end - start).astype(np.float32))
        for kind, own in zip(_BYTE_KINDS, kinds):
            sums = np.concatenate([[0], np.cumsum(kind[part], dtype=np.float64)])
            own.append((sums[end] - sums[start]).astype(np.float32))
    return np.concatenate(codes), np.concatenate(starts), np.concatenate(widths), [np.concatenate(k) for k in kinds]


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A row per passage, and the first passage of each text (one more at the end)."""
    raw = [(t or "").encode() for t in texts]
    lengths = np.array([len(x) + 1 for x in raw], np.int64)
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    begin = np.cumsum(lengths) - lengths
    codes, start, width, kinds = _words(buf)
    first_word = np.append(np.searchsorted(start, begin), len(start))
    count = np.diff(first_word)
    bags = np.maximum(1, -(-count // PASSAGE))
    first = np.concatenate([[0], np.cumsum(bags)])
    n = int(first[-1])
    doc = np.repeat(np.arange(len(raw)), count)
    own = first[doc] + (np.arange(len(codes)) - first_word[doc]) // PASSAGE

    def total(values):
        return np.bincount(own, weights=values, minlength=n).astype(np.float32)

    words = np.bincount(own, minlength=n).astype(np.float32)
    size = np.maximum(1, total(width))
    columns = [total(k) / size for k in kinds]
    per = np.maximum(1, words)
    upper, digit, mark, point, other, _ = kinds
    columns += [total(x) / per for x in (mark + point + other == width, other > 0, (upper == width - mark - point - other) & (upper > 1))]
    for lag in (1, 2, 3):
        again = np.zeros(len(codes), bool)
        again[lag:] = (codes[lag:] == codes[:-lag]) & (own[lag:] == own[:-lag])
        columns.append(total(again) / per)
    columns += [size / per / 10, np.log1p(words)]
    bag = np.bincount(own * HASHED + (codes >> np.uint64(58)).astype(np.int64), minlength=n * HASHED).reshape(n, HASHED)
    return np.concatenate([np.stack(columns, axis=1), bag / per[:, None]], axis=1).astype(np.float32), first


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _product(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``x @ w``, each row summed from left to right, whatever the number of rows."""
    out = np.zeros((len(x), *w.shape[1:]))
    for at in range(0, len(x), ROWS):
        part = out[at : at + ROWS]
        for j, row in enumerate(w):
            part += np.multiply.outer(x[at : at + ROWS, j], row)
    return out


class AttentionModel:
    """Passage layer, gated attention over a bag, logistic output."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        shape = {"W": (FEATURES, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,), "c0": (1,)}
        self.p = {k: rng.normal(0, s[0] ** -0.5, s) if k not in ("b", "c0") else np.zeros(s) for k, s in shape.items()}
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)

    def _forward(self, x: np.ndarray, first: np.ndarray):
        p = self.p
        z = np.tanh(_product(x, p["W"]) + p["b"])
        a, g = np.tanh(_product(z, p["V"])), _sigmoid(_product(z, p["U"]))
        e = _product(a * g, p["w"])
        bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
        e = np.exp(e - np.maximum.reduceat(e, first[:-1])[bag])
        alpha = e / np.add.reduceat(e, first[:-1])[bag]
        m = np.add.reduceat(alpha[:, None] * z, first[:-1])
        return z, a, g, bag, alpha, m, _sigmoid(_product(m, p["c"]) + p["c0"])

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self._forward((x - self.mean) / self.scale, first)[-1]

    def fit(self, bags: list[np.ndarray], y: np.ndarray, epochs: int = 30, batch: int = 128, rate: float = 0.01, decay: float = 1e-3, seed: int = 7):
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(axis=0, dtype=float), every.std(axis=0, dtype=float) + 1e-3
        del every
        rng, p, step = np.random.default_rng(seed), self.p, 0
        first_moment, second_moment = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
        for _ in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), batch):
                take = order[at : at + batch]
                x = (np.concatenate([bags[i] for i in take]) - self.mean) / self.scale
                first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in take])])
                z, a, g, bag, alpha, m, q = self._forward(x, first)
                d = (q - y[take]) / len(take)
                dm = d[:, None] * p["c"]
                dalpha = (z * dm[bag]).sum(axis=1)
                de = alpha * (dalpha - np.add.reduceat(alpha * dalpha, first[:-1])[bag])
                da, dg = de[:, None] * p["w"] * g * (1 - a * a), de[:, None] * p["w"] * a * g * (1 - g)
                dz = (alpha[:, None] * dm[bag] + da @ p["V"].T + dg @ p["U"].T) * (1 - z * z)
                grad = {"W": x.T @ dz, "b": dz.sum(axis=0), "V": z.T @ da, "U": z.T @ dg, "w": (a * g).T @ de, "c": m.T @ d, "c0": d.sum(keepdims=True)}
                step += 1
                for k, v in grad.items():
                    v = v + decay * p[k]
                    first_moment[k] = 0.9 * first_moment[k] + 0.1 * v
                    second_moment[k] = 0.999 * second_moment[k] + 0.001 * v * v
                    p[k] -= rate * (first_moment[k] / (1 - 0.9**step)) / (np.sqrt(second_moment[k] / (1 - 0.999**step)) + 1e-8)


def held_out(column="doc_id"):
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = 3000, passages: int = 100_000) -> AttentionModel:
    """Fit on at most ``sample`` labelled documents outside the held-out fold, of at most ``passages`` passages in all."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other").select("doc_id", "y")
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def encode(batches):
        for block in text_blocks(batches, STEP):
            x, first = features(block.column("text").to_pylist())
            bags = [x[a:b].tobytes() if b - a <= passages else None for a, b in zip(first[:-1], first[1:])]
            yield pa.record_batch([block.column("doc_id"), block.column("y"), pa.array(np.diff(first), pa.int64()), pa.array(bags, pa.binary())], names=["doc_id", "y", "size", "bag"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")  # at most ``sample`` rows
    held = stored(chosen.mapInArrow(encode, "doc_id long, y int, size long, bag binary"), "quality-bags")
    one = F.min_by(F.struct("y", "size", "bag"), F.struct(F.xxhash64("bag"), "size"))  # of rows that share an id
    bags = held.where("bag is not null").groupBy("doc_id").agg(one.alias("one")).select("doc_id", "one.*")
    room, taken = passages, []
    for r in bags.select("doc_id", "size").orderBy(F.xxhash64("doc_id"), "doc_id").collect():  # at most ``sample``
        if r["size"] <= room:
            room -= r["size"]
            taken.append(r.doc_id)
    got = bags.where(F.col("doc_id").isin(taken)).orderBy("doc_id").collect()
    discard(held)
    model = AttentionModel()
    y = np.array([r.y for r in got], float)
    if len(set(y)) == 2:
        model.fit([np.frombuffer(r.bag, np.float32).reshape(-1, FEATURES) for r in got], y)
    else:
        model.p["c"], model.p["c0"] = np.zeros(HIDDEN), np.zeros(1)
    return model


def score(docs: DataFrame, model: AttentionModel, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``score`` (1: good) and ``predicted``; columns of these names are replaced, all others kept."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size
    schema = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")]).schema

    def apply(batches):
        for block in text_blocks(batches, STEP):
            x, first = features(block.column("text").to_pylist())
            s = shared.value.score(x, first)
            yield pa.record_batch(block.columns + [pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], names=[*block.schema.names, "score", "predicted"])

    from pyspark.sql.types import DoubleType, IntegerType

    return docs.select(*schema.names).mapInArrow(apply, schema.add("score", DoubleType()).add("predicted", IntegerType()))


def keep(docs: DataFrame, model: AttentionModel, threshold: float = 0.3) -> DataFrame:
    """``docs`` without those that score below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size

    def apply(batches):
        for block in text_blocks(batches, STEP):
            x, first = features(block.column("text").to_pylist())
            yield block.filter(pa.array(shared.value.score(x, first) >= threshold))

    return docs.mapInArrow(apply, docs.schema)
