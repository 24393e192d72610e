"""Token ids of whole texts by a tokenizer file, a block of texts at a time.

The tokenizer works on each run of non-space characters by itself, and within a run letters,
digits and other signs never share a token. So a block's distinct runs are taken apart into a
core and closing signs, each distinct part is encoded once in a worker's life, and every text
is put together from the parts' ids.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Distinct parts kept by a worker; beyond it the store starts anew.
STORE_PARTS = 600_000
CLOSING = ".,!?;:|*$%&#"
#: A run of its own between parts that are encoded together; parts that hold it go alone.
BETWEEN = "\x02"
TOGETHER = 500
#: Texts of more characters are encoded in pieces, cut at white space.
LONG = 4 << 20
SPACE = re.compile(r"[ \t\n\v\f\r]")

_OF_WORKER: dict[tuple[str, bool], "BlockTokenizer"] = {}


def worker_tokenizer(path: str, ordinary: bool = False) -> "BlockTokenizer":
    """The tokenizer that this worker process keeps between tasks."""
    if (path, ordinary) not in _OF_WORKER:
        _OF_WORKER[path, ordinary] = BlockTokenizer(path, ordinary)
    return _OF_WORKER[path, ordinary]


def pieces(text: str) -> list[str]:
    """A text, or its pieces of about ``LONG`` characters if it is longer."""
    out, at = [], 0
    while len(text) - at > LONG and (space := SPACE.search(text, at + LONG)):
        out.append(text[at : space.start()])
        at = space.start()
    return [*out, text[at:]] if out else [text]


def parts(run: str) -> tuple[str, str]:
    """Core and closing signs; both encode as they do within the run, in lower case too."""
    if "<|" in run or BETWEEN in run:
        return run, ""
    core = run.rstrip(CLOSING)
    if len(core) < len(run) and core and not (core[-1].isalnum() and core[-1] < "\u0250"):
        return run, ""
    return (core.lower() if core.isascii() else core), run[len(core) :]


class BlockTokenizer:
    """Encodes lists of texts; ``ordinary`` reads special tokens' strings as plain text.

    For tokenizers that lower-case, drop white space and keep letters, digits and other signs
    in tokens of their own.
    """

    def __init__(self, path: str, ordinary: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary
        self.between = self._raw([BETWEEN])[0]
        self._clear()

    def _raw(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _clear(self) -> None:
        self.place: dict[str, int] = {"": 0}
        self.starts = np.zeros(2, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, new: list[str]) -> None:
        plain = [p for p in new if BETWEEN not in p] if len(self.between) == 1 else []
        alone = [p for p in new if BETWEEN in p] if len(self.between) == 1 else new
        ids, counts = [self.ids], []
        joined = self._raw([f" {BETWEEN} ".join(plain[i : i + TOGETHER]) for i in range(0, len(plain), TOGETHER)])
        for got in joined:
            got = np.array(got, np.uint32)
            cut = got == self.between[0]
            ends = np.append(np.flatnonzero(cut), len(got))
            counts.append(np.diff(ends, prepend=-1) - 1)
            ids.append(got[~cut])
        for got in self._raw(alone):
            counts.append([len(got)])
            ids.append(np.array(got, np.uint32))
        for p in plain + alone:
            self.place[p] = len(self.place)
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.concatenate(counts))])
        self.ids = np.concatenate(ids)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and where each text's ids start (one more at the end)."""
        cut = [pieces(t or "") for t in texts]
        if len(texts) == sum(map(len, cut)):
            return self._encode([p[0] for p in cut])
        got = [[self._encode([piece])[0] for piece in own] for own in cut]
        counts = [sum(map(len, own)) for own in got]
        return np.concatenate([x for own in got for x in own]), np.concatenate([[0], np.cumsum(counts)])

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        runs = split.values.dictionary_encode()
        if len(self.place) > STORE_PARTS:
            self._clear()
        taken = [p for run in runs.dictionary.to_pylist() for p in parts(run)]
        if new := list(dict.fromkeys(p for p in taken if p not in self.place)):
            self._learn(new)
        known = np.fromiter((self.place[p] for p in taken), np.int64, len(taken)).reshape(-1, 2)
        at = known[runs.indices.to_numpy(zero_copy_only=False)].ravel()
        first = self.starts[at]
        count = self.starts[at + 1] - first
        before = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.repeat(first - before[:-1], count) + np.arange(before[-1])]
        return ids, before[split.offsets.to_numpy() * 2]


def text_blocks(batches, size: int = 8 << 20):
    """Rows of Arrow batches in runs of about ``size`` characters: one batch slice each."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64) + 64)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + size, side="right")))
            yield batch.slice(at, to - at)
            at = to
        pa.default_memory_pool().release_unused()
