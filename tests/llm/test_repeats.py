"""Operators 2 and 9 against brute force, with ordinary and with tiny limits."""

import hashlib
import zlib

import numpy as np
import pytest
from helpers import SF001, frame, odd_rows, removed, words

from adoptlens.llm import lz_dedup, repeats, suffix_dedup

KINDS = {
    "words": (lz_dedup.dedup, 13, words, b" ".join),
    "bytes": (suffix_dedup.dedup, 50, lambda t: list((t or "").encode()), bytes),
}


def compare(docs, kind, window):
    run, _, split, joined = KINDS[kind]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = []
    for (i, _), (w, gone) in zip(rows, removed(rows, window, split)):
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        rest = joined([x for x, g in zip(w, gone) if not g])
        want.append((i, len(w), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    got = [(r.doc_id, r.n_symbols, r.n_removed, len(r.spans), r.kept_sha256) for r in run(docs, window).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("kind", KINDS)
def test_odd_rows(spark, kind):
    compare(frame(spark), kind, KINDS[kind][1])


@pytest.mark.parametrize("kind", KINDS)
def test_documents_with_tiny_limits(spark, kind, monkeypatch):
    for name, value in {"CROWD": 1, "SPLIT": 2, "ROW_STEP": 2000, "BLOCK": 3000, "TEXT_STEP": 20000}.items():
        monkeypatch.setattr(repeats, name, value)
    compare(spark.read.parquet(f"{SF001}/documents.parquet").repartition(5), kind, KINDS[kind][1])


@pytest.mark.parametrize("kind", KINDS)
def test_a_line_that_every_document_holds(spark, kind):
    line = " ".join(f"common{i}" for i in range(20))
    rows = [(i, f"start{i} of{i * 7} {line} end{i} and{i * 3} more", "en", "s", 1) for i in range(300)]
    compare(frame(spark, rows).repartition(7), kind, KINDS[kind][1])


@pytest.mark.parametrize("kind", KINDS)
def test_empty_table_and_clashing_columns(spark, kind):
    run, window = KINDS[kind][:2]
    assert run(frame(spark, []), window).collect() == []
    docs = frame(spark).selectExpr("*", "1 AS spans", "2 AS n_removed", "3 AS places", "4 AS doc", "5 AS kept")
    assert run(docs, window).count() == len(odd_rows())


@pytest.mark.parametrize("kind", KINDS)
def test_rows_of_one_id_keep_their_own_marks(spark, kind):
    passage = " ".join(f"common{i}" for i in range(20))
    with_it = {zlib.crc32(t.encode()) & 0x7FFFFF: t for t in (f"a{k} {passage}" for k in range(20_000))}
    without = (f"b{k} " + " ".join(f"other{i}" for i in range(20)) for k in range(20_000))
    # equal in 23 bits of a check sum
    other = next(t for t in without if zlib.crc32(t.encode()) & 0x7FFFFF in with_it)
    texts = [with_it[zlib.crc32(other.encode()) & 0x7FFFFF], other, other]
    rows = [(1, passage)] + [(i, t) for i in (None, 8) for t in texts]
    compare(frame(spark, [(i, t, "en", "s", 1) for i, t in rows[:4]]), kind, KINDS[kind][1])
    compare(frame(spark, [(i, t, "en", "s", 1) for i, t in rows]), kind, KINDS[kind][1])


def test_long_text_in_steps(monkeypatch):
    rng = np.random.default_rng(3)
    text = " ".join(map(str, rng.integers(0, 50, 4000))).encode()
    whole = repeats.word_bytes(np.frombuffer(text, np.uint8))
    monkeypatch.setattr(repeats, "TEXT_STEP", 700)
    for a, b in zip(whole, repeats.word_bytes(np.frombuffer(text, np.uint8))):
        assert (a == b).all()
    held, begin, end = repeats.symbols([text], True)
    scheme = repeats.Scheme(13, 5, True)
    monkeypatch.setattr(repeats, "SYMBOL_STEP", 100)
    covered = np.concatenate([np.arange(f, f + n) for *_, first, count in repeats.segments(held, begin, end, scheme) for f, n in zip(first, count)])
    assert (np.sort(covered) == np.arange(4000 - 12)).all()


def test_windows_find_the_smallest_reference():
    a, b = np.arange(1, 41, dtype=np.uint64), np.arange(101, 131, dtype=np.uint64)
    mixed = np.concatenate([a[10:30], b[5:25]])
    held = np.concatenate([a, b, mixed])
    found = lz_dedup.references(held, np.array([0, 40, 70, 110]), np.array([1, 2, 3]), 13)
    want = np.full(110, -1)
    want[70:78], want[90:98] = np.arange(10, 18), np.arange(45, 53)
    assert (found == want).all()


@pytest.mark.parametrize("limits", [{}, {"CROWD": 1, "SPLIT": 2, "ROW_STEP": 50, "BLOCK": 200, "TEXT_STEP": 600}])
def test_factors_follow_their_reference_and_meet_at_boundaries(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(repeats, name, value)
    a, b = ([f"{x}{i}" for i in range(300)] for x in "ab")
    third = ["start"] + a[20:170] + ["gap"] + a[200:212] + ["gap"] + b[40:140] + b[10:30] + ["end"]
    fourth = third[:120] + b[:60]
    rows = [(k + 1, " ".join(w), "en", "s", 1) for k, w in enumerate((a, b, third, fourth))]
    got = {r.doc_id: r for r in lz_dedup.dedup(frame(spark, rows).repartition(3, "doc_id")).collect()}
    # 150 and 100 words are more than any segment holds; 12 words are no factor
    assert [tuple(f) for f in got[3].factors] == [(1, 151, 1, 20), (165, 265, 2, 40), (265, 285, 2, 10)]
    assert [tuple(s) for s in got[3].spans] == [(1, 151), (165, 285)]
    assert got[1].factors == got[2].factors == []
    # the windows around "start" are in the third alone; which of the two is followed from there on is open
    assert [tuple(s) for s in got[4].spans] == [(0, 180)] and tuple(got[4].factors[-1]) == (120, 180, 2, 0)
    texts = {1: a, 2: b, 3: third}
    assert all(fourth[f.start : f.end] == texts[f.reference][f.there : f.there + f.end - f.start] for f in got[4].factors)
    assert max(f.end - f.start for f in got[4].factors) > 100


def test_every_span_is_a_union_of_true_factors(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    texts = {r.doc_id: words(r.text) for r in docs.collect()}
    longest = 0
    for r in lz_dedup.dedup(docs).collect():
        covered = [False] * r.n_symbols
        for f in r.factors:
            assert f.reference < r.doc_id and f.end - f.start >= 13
            assert texts[r.doc_id][f.start : f.end] == texts[f.reference][f.there : f.there + f.end - f.start]
            covered[f.start : f.end] = [True] * (f.end - f.start)
            longest = max(longest, f.end - f.start)
        assert sum(covered) == r.n_removed
    assert longest > 60


def test_buckets_are_equal_strings():
    rng = np.random.default_rng(1)
    for window in (3, 8, 12, 50):
        held = rng.integers(97, 99, 3000).astype(np.uint8)
        first = np.array([0, 900, 930, 2000, 3000])
        at, bucket = suffix_dedup.buckets(held, first, window)
        names = {}
        for i, b in zip(at, bucket):
            assert names.setdefault(held[i : i + window].tobytes(), b) == b
        assert len(set(bucket)) == len(names)
        assert len(at) == sum(max(0, n - window + 1) for n in np.diff(first))


def test_cut_replaces_text_and_drops_what_is_left_blank(spark):
    rows = [(r[0], r[1]) for r in odd_rows()]
    got = {(r.doc_id, r.text, r.n_chars) for r in suffix_dedup.cut(frame(spark), 50).collect()}
    want = set()
    for (i, text), (w, gone) in zip(rows, removed(rows, 50, KINDS["bytes"][2])):
        rest = text if not any(gone) else bytes(x for x, g in zip(w, gone) if not g).decode("utf-8", "ignore")
        if not any(gone) or rest.strip():
            want.add((i, rest, None if rest is None else len(rest)))
    assert got == want
    assert suffix_dedup.cut(frame(spark), 50).columns == frame(spark).columns
