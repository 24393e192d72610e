"""Operators 11, 12 and 13 against brute force and round trips."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import LOW, SF01, frame, odd_rows, words
from pyspark.sql import functions as F

from adoptlens.llm import fim, host_rules, phrases

# --- 11: fill-in-middle ----------------------------------------------------------------------


@pytest.mark.parametrize("share", [0.0, 0.01, 0.3, 0.97, 1.0])
def test_boundary_set_selects_and_ranks(share):
    rng = np.random.default_rng(3)
    flags = rng.random(200_000) < share
    flags[70_000:75_000] = True
    flags[140_000:190_000] = False
    places = np.flatnonzero(flags)
    got = fim.BoundarySet(lambda a, b: np.append(flags[a:b], [False] * (b - a - len(flags[a:b]))), len(flags))
    assert len(got) == len(places)
    assert (got.select(np.arange(len(places))) == places).all()
    asked = np.append(rng.integers(0, len(flags), 5000), [0, len(flags), 65_535, 65_536])
    assert (got.rank(asked) == np.searchsorted(places, asked)).all()


def test_containers_are_the_smallest():
    kinds = [fim.container(np.array(p)) for p in (range(65536), range(0, 65536, 2), range(0, 65536, 40), [])]
    assert [type(k).__name__ for k in kinds] == ["RunContainer", "BitmapContainer", "ArrayContainer", "ArrayContainer"]


def expected_form(i, text):
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not n or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle(spark):
    more = [(100 + k, t, "en", "s", 1) for k, t in enumerate(["é" * 7, "a<P>b", "x<S", "𝔘ni 𝔠ode\n\r" * 30_000, "<", "<M", "a\x00b", "word " * 60_000] * 3)]
    docs = frame(spark, odd_rows() + more).withColumns({"Form": F.lit(1), "cut": F.lit(2)})
    rows = fim.transform(docs).withColumn("again", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(rows) == len(odd_rows() + more) and rows[0].cut == 2
    for r in rows:
        assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == expected_form(r.doc_id, r.text)
        assert r.again == (r.text or "")
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    assert fim.transform(frame(spark, [])).collect() == []


@pytest.mark.parametrize("units, pattern", [("words", r"^\s+|\S+\s*"), ("lines", r"[^\n]*\n|[^\n]+")])
def test_fill_in_middle_of_other_units(spark, units, pattern):
    docs = frame(spark, odd_rows() + [(60, "one\ntwo three\n\n four", "en", "s", 1), (61, "  a b", "en", "s", 1)])
    for r in fim.transform(docs, units=units, plain=100).collect():
        parts = re.findall(pattern, r.text or "", re.ASCII)
        assert r.n == len(parts)
        if r.form != "plain":
            whole = "".join(parts[: r.prefix_units])
            assert r.output.split("<P>")[1].startswith(whole)
            assert r.output.endswith("<M>" + "".join(parts[r.prefix_units : r.prefix_units + r.middle_units]))


def test_fill_in_middle_of_whole_table(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    for r in fim.transform(docs).collect():
        assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == expected_form(r.doc_id, r.text)


# --- 12: host rules --------------------------------------------------------------------------


def measures(text):
    text = text or ""
    w = [x.decode() for x in words(text)]
    lines = [x for x in text.split("\n") if words(x)]
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    count = Counter(grams)
    hit = {k + j for k, g in enumerate(grams) if count[g] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def expected_rates(rows):
    hosts = defaultdict(lambda: [0, 0])
    for host, failed in rows:
        if host is not None:
            hosts[host][0] += 1
            hosts[host][1] += failed
    n, f = (np.array([v[k] for v in hosts.values()], float) for k in (0, 1))
    mean, k = f.sum() / n.sum(), len(n)
    weight = n.sum()
    if k > 1:
        spread = k * (n * (f / n - mean) ** 2).sum() / ((k - 1) * n.sum())
        between = spread - mean * (1 - mean) * (1 / n).sum() / k
        if between > 1e-15:
            weight = min(max(1.0, (mean * (1 - mean) - spread) / between), n.sum())
    return {h: (v[1] + mean * weight) / (v[0] + weight) for h, v in hosts.items()}


def hosted(k):
    """Hosts of different failure rates, one without any, one of a single row, and null."""
    long = lambda i: " ".join(f"w{i}x{j}" for j in range(60))
    rows = [(i, long(i), "en", f"good{i % 5}", 1) for i in range(60)]
    rows += [(100 + i, long(i) if i % 10 == 0 else "short", "en", "bad", 1) for i in range(40)]
    rows += [(200, "short", "en", "single", 1), (201, "short", "en", None, 1), (202, long(9), "en", None, 1), (None, "a b a b a b " * 20, "en", "good0", 1)]
    return rows + [(300, "l1 # x\nl1 # x\n \n \nl1 # x\r\n<é>&", "en", "good1", 1), (300, None, "en", "good1", 1), (301, long(5), "en", "bad", 1)][:k]


def test_host_rules(spark):
    data = odd_rows() + hosted(3)
    docs = frame(spark, data).withColumns({"host": F.lit("x"), "n": F.lit(1), "kept": F.lit(2)})
    got = host_rules.judge(docs, most=0.5).collect()
    want = []
    for i, text, _, host, _ in data:
        m = measures(text)
        want.append((i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0], host))
    rates = expected_rates([(w[-1], w[-2]) for w in want])
    assert rates["bad"] > 0.5 and rates["single"] < 1
    full = [(*w[:-1], not w[-2] and not rates.get(w[-1], 0) > 0.5) for w in want]
    assert sorted(map(str, full)) == sorted(str((r.doc_id, *(r[m] for m in host_rules.MEASURES), r.base_failed, r.kept)) for r in got)
    for r in got:
        assert r.host is None or r.host_rate == pytest.approx(rates[r.host], abs=1e-8)
    assert any(not r.kept and not r.base_failed for r in got)
    left = host_rules.keep(docs)
    assert left.columns == docs.columns and left.count() == sum(r.kept for r in got)


def test_host_rules_of_nothing_and_of_one_host(spark):
    assert host_rules.judge(frame(spark, [])).collect() == []
    one = host_rules.judge(frame(spark, [(k, "w " * k, "en", "s", 1) for k in range(10)])).collect()
    assert {r.host_rate for r in one} == {1.0} and not any(r.kept for r in one)
    none = host_rules.judge(frame(spark, [(1, " ".join(map(str, range(70))), "en", None, 1)])).collect()
    assert none[0].kept and none[0].host_rate is None


def test_host_rules_run_no_python(spark):
    plan = host_rules.measured(frame(spark), "source")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Exchange", plan)


# --- 13: collocations ------------------------------------------------------------------------


def expected_collocations(rows, support, top):
    out = []
    by_lang = defaultdict(list)
    for text, lang in rows:
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().translate(LOW)):
            by_lang["und" if lang is None else lang].append(re.findall(rb"[^\x20\x09]+", piece))
    for lang, pieces in by_lang.items():
        f = Counter(tuple(w[i : i + k]) for w in pieces for k in (1, 2, 3, 4) for i in range(len(w) - k + 1))
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        rest = []
        for p, a in cand.items():
            around = [b for q, b in cand.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= 80 * a for b in around):
                continue
            score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rest.append((-score, -a, b" ".join(p), l, r))
        n = sum(map(len, pieces))
        out += [(lang, k + 1, p.decode(), -a, l, r, n, -s) for k, (s, a, p, l, r) in enumerate(sorted(rest)[:top])]
    return sorted(out)


def phrase_rows():
    rng = np.random.default_rng(8)
    vocabulary = ["the", "The", "New", "York", "city", "é", "ein", "x.y", "of", "a\tb", "um;", "z\x0b"]
    rows = [(" ".join(rng.choice(vocabulary, rng.integers(0, 60))), ["en", "de", None, "und"][k % 4]) for k in range(150)]
    return rows + [(None, "en"), ("", "en"), ("the " * 50, "en"), ("New York City", "en"), ("of, the.\n", None), (" ".join(["new york"] * 400) + ". " + "ein um " * 300, "fr")]


@pytest.mark.parametrize("support, size", [(4, 1 << 20), (4, 3000), (9, 900), (3, 1), (30, 400)])
def test_collocations(spark, support, size):
    rows = phrase_rows()
    docs = spark.createDataFrame([(k, t, g, 1, "k") for k, (t, g) in enumerate(rows)], "doc_id long, text string, lang string, n int, phrase string").repartition(5)
    want = expected_collocations(rows, support, 40)
    got = phrases.collocations(docs, support=support, top=40, size=size).collect()
    assert sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got) == want and len(want) > 10


def test_collocations_of_nothing(spark):
    assert phrases.collocations(frame(spark, [])).collect() == []
    assert phrases.collocations(frame(spark, [(1, None, None, None, None)])).collect() == []


def test_large_counts_stay_exact(spark):
    a = 9_000_000_000_000_000
    got = spark.sql(f"SELECT (cast({a}L as decimal(30,0)) * 2000000) div (cast({a}L as decimal(30,0)) + cast(1 as decimal(30,0))) AS s").first().s
    assert got == 2_000_000 * a // (a + 1)


def test_local_support_is_lowered(spark, monkeypatch):
    """With few shards only phrases near the lowered support reach the candidates."""
    rows = [(" ".join(f"u{k}x{j}" for j in range(100)) + " often seen", "en") for k in range(40)]
    docs = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    seen = []
    real = phrases.keys_of
    monkeypatch.setattr(phrases, "keys_of", lambda df: seen.append(df.count()) or real(df))
    found = phrases.frequent(docs, support=30, size=1 << 20).where("k > 0").collect()
    assert sorted(r.phrase for r in found) == ["often", "often seen", "seen"]
    assert seen[0] == 3  # of some 8000 phrases
