"""Operators 1, 3, 4, 5, 6 and 10 against brute force, round trips or held-out accuracy."""

import json
import re
import zlib

import numpy as np
import pytest
from helpers import SF01, frame, odd_rows

from adoptlens.llm import chat_format, decontaminate, packing, quality, queries, separator_scan, tokens, url_filter
from adoptlens.llm.tables import stored

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BPE = queries.tokenizer_file("word_bpe_49k.json")


# --- 4: decontamination --------------------------------------------------------------------

def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id long")


ITEMS = [(1, " ".join(f"q{i}" for i in range(30)), 0), (2, "Short ITEM, of five words", 0), (3, "Éa b", 0), (4, None, 0), (5, " .. ", 0), (None, "no id here", 0), (2, "twice the same id", 0), (12, "éa b", 0)]


def norm(text):
    return WORD.findall((text or "").translate(LOW))


def expected_hits(docs, items, n=13):
    grams = {}
    for i, text in items:
        w = norm(text)
        size = min(n, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            grams.setdefault(tuple(w[k : k + size]), set()).add(i)
    out = []
    for i, text in docs:
        w, hit, found = norm(text), set(), set()
        for size in {len(g) for g in grams}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in grams:
                    hit.update(range(k, k + size))
                    found |= grams[tuple(w[k : k + size])]
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_decontamination(spark):
    q = ITEMS[0][1]
    more = [(30, f"before {q} after", "en", "s", 1), (31, "x " * 400 + q[:60].upper(), "en", "s", 1), (32, "short item of, FIVE words éa b", "en", "s", 1), (33, " ".join(q.split()[:12]), "en", "s", 1), (34, "ÉA b no id here", "en", "s", 1)]
    docs = frame(spark, odd_rows() + more).selectExpr("*", "1 AS w", "2 AS item_id", "3 AS hash")
    items = bench(spark, ITEMS)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected_hits(rows, [(i, t) for i, t, _ in ITEMS])
    got = decontaminate.hits(docs, items).collect()
    assert sorted([(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got], key=str) == want
    assert all(sum(s.end - s.start for s in r.spans) == r.n_hit for r in got)
    left = decontaminate.clean(docs, items)
    bad = sum(x[-1] for x in want)
    assert bad >= 3 and left.count() == len(rows) - bad and left.columns == docs.columns


def test_decontamination_of_nothing(spark):
    assert decontaminate.hits(frame(spark, []), bench(spark, ITEMS)).collect() == []
    got = decontaminate.hits(frame(spark), bench(spark, [])).collect()
    assert len(got) == len(odd_rows()) and not any(r.contaminated or r.n_hit for r in got)
    assert {r.n_words for r in got if r.doc_id == 9} == {0}


def test_decontamination_without_a_broadcast(spark, monkeypatch):
    """The shuffled plan gives the same, and no exchange carries texts or words."""
    docs, items = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "benchmark"))
    docs = docs.limit(150)
    want = expected_hits([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    monkeypatch.setattr(decontaminate, "BROADCAST_HASHES", 0)
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in held:
        spark.conf.set(k, "-1")
    try:
        known = stored(decontaminate.grams(items, 13), "windows")
        plan = decontaminate._looked_up(spark.read.parquet(f"{SF01}/documents.parquet"), known, [13])._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan and "Exchange hashpartitioning(hash" in plan
        below = plan[plan.index("Exchange hashpartitioning(hash") :]
        assert re.search(r"Generate posexplode\S*\(hashes#\d+\), \[row#\d+L, doc_id#\d+L, text_hash#\d+L, n_words#\d+\]", below)
        got = [(r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in decontaminate.hits(docs, items).collect()]
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert sorted(got, key=str) == want


# --- 5: quality ----------------------------------------------------------------------------

def test_quality_is_learned_outside_the_held_out_fold(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    got = queries.op5_attention_quality(spark, SF01).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.93
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad]) > 0.85  # area under the curve
    kept = quality.keep(docs, quality.train(docs, labels), 0.3)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} >= {r.doc_id for r in got if r.predicted}


def test_quality_of_odd_rows(spark):
    docs = frame(spark).selectExpr("*", "1 AS y", "2 AS bag", "'x' AS score")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    flat = quality.score(docs, quality.train(docs, none)).collect()
    assert len(flat) == len(odd_rows()) and {r.score for r in flat} == {0.5}
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(30)] + [(None, 1, 0), (3, None, 0), (5, 7, 0)], none.schema)
    got = quality.score(docs, quality.train(docs, labels)).collect()
    assert len(got) == len(odd_rows()) and len({r.score for r in got if not (r.text or "").strip()}) == 1
    model = quality.train(frame(spark, []), labels)
    assert quality.score(frame(spark, []), model).collect() == []


def test_score_depends_on_the_text_alone(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.select("doc_id", "text")
    model = quality.train(docs, labels)
    one, many = ({r.doc_id: r.score for r in quality.score(docs.repartition(n, "doc_id"), model).collect()} for n in (1, 37))
    assert one == many
    short = quality.train(docs, labels, passages=400)
    assert short.p["c0"] != model.p["c0"] and len(quality.score(docs, short).collect()) == len(one)


def test_features_of_a_long_text_in_steps(monkeypatch):
    from adoptlens.llm import repeats

    texts = [t for _, t, *_ in odd_rows()]
    whole = quality.features(texts)
    monkeypatch.setattr(repeats, "TEXT_STEP", 50)
    for a, b in zip(whole, quality.features(texts)):
        assert np.allclose(a, b)


def test_attention_gradient():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(rng.integers(1, 6), quality.FEATURES)) for _ in range(60)]
    y = np.array([float(b[:, 3].max() > 1) for b in bags])
    model = quality.AttentionModel()
    model.fit(bags, y, epochs=120)
    score = model.score(np.concatenate(bags), np.concatenate([[0], np.cumsum([len(b) for b in bags])]))
    assert ((score > 0.5) == y).mean() > 0.9


# --- 6: urls -------------------------------------------------------------------------------

def expected_rule(url, rules):
    """Host, path, longest rule and its verdict, by hand."""
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest, re.DOTALL).group()
        path = re.match(r"[^?#]*", rest[len(host) :], re.DOTALL).group()
        host = host.translate(LOW)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return (host, path, best.host + best.path, best.verdict) if best else (host, path, None, None)


def test_rules_on_every_page(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet").select("page_id", "url")
    got = {r.page_id: (r.host, r.path, r["rule"], r.verdict) for r in queries.op6_gbt_url_filter(spark, SF01).collect()}
    rows = pages.collect()
    assert len(got) == len(rows) > 100
    for r in rows:
        *known, verdict = expected_rule(r.url, queries.URL_RULES)
        assert got[r.page_id][:3] == tuple(known) and got[r.page_id][3] in ("allow", "block")
        assert verdict is None or got[r.page_id][3] == verdict


URLS = [
    (1, "http://Example.ORG/es/1", "example.org", "/es/1", "example.org/es/", "block"), (2, "https://a.example.org/en/12?x=1", "a.example.org", "/en/12", "example.org/en/1", "block"),
    (3, "https://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"), (4, "http://x.com/fr/", "x.com", "/fr/", "com/fr/", "allow"),
    (5, "http://x.com/fr", "x.com", "/fr", None, None), (6, "http://org", "org", "", None, None), (7, "http://org/", "org", "/", "org/", "allow"),
    (8, "no scheme org/x", "", "", None, None), (9, None, "", "", None, None), (10, "", "", "", None, None), (11, "x://y.com/de/?a://b", "y.com", "/de/", "com/de/", "block"),
    (12, "http://É.Com#/de/", "É.com", "", None, None), (13, "http://y.com?/de/", "y.com", "", None, None), (None, "http://z.org/a", "z.org", "/a", "org/", "allow"),
    (1, "http://Example.ORG/es/1", "example.org", "/es/1", "example.org/es/", "block"), (15, "://h.com/de/x", "h.com", "/de/x", "com/de/", "block"),
]


def pages(spark, urls):
    return spark.createDataFrame([(u[0], u[1], None, "z") for u in urls], "page_id long, url string, html string, label string")


def test_url_rules(spark):
    got = url_filter.judge(pages(spark, URLS), queries.URL_RULES).collect()
    assert sorted([(r.page_id, r.host, r.path, r.rule) for r in got], key=str) == sorted([(u[0], u[2], u[3], u[4]) for u in URLS], key=str)
    assert all(r.verdict in ("allow", "block") for r in got)
    by_rule = {r.rule: r.verdict for r in got if r.rule}
    assert by_rule == {u[4]: u[5] for u in URLS if u[4]}


def test_urls_without_labels_or_of_one_kind(spark):
    assert url_filter.judge(pages(spark, []), queries.URL_RULES).collect() == []
    free = [u for u in URLS if u[4] is None]
    assert {r.verdict for r in url_filter.judge(pages(spark, free), queries.URL_RULES).collect()} == {"allow"}
    blocked = free + [u for u in URLS if u[5] == "block"]
    assert {r.verdict for r in url_filter.judge(pages(spark, blocked), queries.URL_RULES).collect()} == {"block"}


def test_trees_learn_what_urls_show(spark):
    rules = [url_filter.Rule("org", "/", "allow"), url_filter.Rule("com", "/", "block")]
    rows = [(k, f"http://h{k}.{'org/text' if k % 2 else 'com/' + str(k * 7919) * 3}", "", "", None, None) for k in range(200)]
    rows += [(1000 + k, f"http://h{k}.net/{'text' if k % 2 else str(k * 7907) * 3}", "", "", None, None) for k in range(40)]
    got = [r for r in url_filter.judge(pages(spark, rows), rules).collect() if r.page_id >= 1000]
    assert all((r.verdict == "allow") == bool(r.page_id % 2) for r in got)


# --- 10: packing, 3: separators --------------------------------------------------------------

def raw_ids(text, ordinary=False):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = ordinary
    return t.encode(text or "", add_special_tokens=False).ids


ODD_TEXTS = [None, "", " \n\t\x0b\x0c\r x", "Hello  World's 123 <|endoftext|> a<|ENDOFTEXT|>b", "U\u0308 H\u0331 T\u0308 nbsp\xa0em\x85nel ΣΑΣ İst", "a\x1cb \x02 c\x02d", "你好 мир 🙂", "x.y., ...!! ½. ²,", "word" * 500]


@pytest.mark.parametrize("ordinary", [False, True])
def test_block_tokenizer_equals_the_tokenizer(ordinary, monkeypatch):
    monkeypatch.setattr(tokens, "STORE_PARTS", 5)
    t = tokens.BlockTokenizer(BPE, ordinary)
    monkeypatch.setattr(tokens, "LONG", 9)
    for texts in (ODD_TEXTS, ODD_TEXTS[::-1], ["plain"]):
        ids, starts = t.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])] == [raw_ids(x, ordinary) for x in texts]


def check_packing(rows, got, window):
    pieces = {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    want = [np.array(raw_ids(t) + [1], "<u4") for _, t in rows]
    total = sum(len(w) for w in want)
    assert sum(r.length for r in got) == total
    expected = sorted((str(i), at, min(window, len(w) - at), zlib.crc32(w[at : at + window].tobytes()), len(w)) for (i, _), w in zip(rows, want) for at in range(0, len(w), window))
    assert sorted((str(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == expected
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    waste = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= window
        waste += window - end if end & (end - 1) else 0
    return waste / (waste + total)


def test_packing(spark):
    docs = frame(spark, odd_rows() + [(90 + k, t, "en", "s", 0) for k, t in enumerate(ODD_TEXTS)]).selectExpr("*", "1 AS part", "2 AS length")
    check_packing([(r.doc_id, r.text) for r in docs.collect()], packing.pack(docs, BPE, 64).collect(), 64)
    docs = spark.read.parquet(f"{SF01}/documents.parquet").repartition(5)
    assert check_packing([(r.doc_id, r.text) for r in docs.collect()], packing.pack(docs, BPE).collect(), 2048) < 0.005
    assert packing.pack(docs.limit(0), BPE).collect() == []


def test_plans_use_every_length_once():
    rng = np.random.default_rng(3)
    for counts in (rng.poisson(3, 129), rng.poisson(0.1, 129), np.bincount([100] * 500 + [28] * 100 + [5], minlength=129), np.zeros(129, int)):
        counts = counts.copy()
        counts[[0, 128]] = 0
        used = np.zeros(129, int)
        for lengths, times in packing.plan(counts, 128):
            assert sum(lengths) <= 128 and times > 0
            for n in lengths:
                used[n] += times
        assert (used == counts).all()


def test_least_squares_uses_up_a_histogram_of_whole_windows():
    counts = np.zeros(129, int)
    counts[[100, 28, 60, 68]] = 50, 50, 30, 30
    combos = packing.combinations(counts, 128)
    x = packing.repeats(combos, counts)
    used = sum(xi * np.bincount(c[c > 0], minlength=129) for xi, c in zip(x, combos))
    assert (x >= 0).all() and np.abs(used - counts).max() < 1


def test_separator_scan(spark, monkeypatch):
    docs = frame(spark, odd_rows() + [(90 + k, t, "en", "s", 0) for k, t in enumerate(ODD_TEXTS)]).repartition(3).persist()
    want = sorted(len(raw_ids(r.text, True)) for r in docs.collect())
    for block, run in ((1 << 18, 256), (37, 2), (5, 3)):
        monkeypatch.setattr(separator_scan, "RUN", run)
        files = stored(separator_scan.write_tokens(docs, BPE, 49407, block), "token-files")
        rows = separator_scan.scan(files, 49407).orderBy("file", "ordinal").collect()
        assert sorted(r.n_tokens for r in rows) == want and all(r.closed for r in rows)
        at = {}
        for r in rows:
            assert (r.ordinal, r.start) == at.get(r.file, (0, 0))
            at[r.file] = (r.ordinal + 1, r.start + r.n_tokens + 1)
    docs.unpersist()
    assert separator_scan.scan(files.limit(0), 49407).collect() == []


def test_separator_scan_of_flat_files(spark, tmp_path):
    np.array([5, 6, 9, 9, 7], "<u4").tofile(tmp_path / "a.bin")
    np.array([1, 2, 3], "<u4").tofile(tmp_path / "b.bin")
    np.array([9], "<u4").tofile(tmp_path / "c.bin")
    (tmp_path / "d.bin").touch()
    blocks = separator_scan.read_files(spark, str(tmp_path), block=2, width=4)
    got = sorted((r.file[-5:], r.ordinal, r.start, r.n_tokens, r.closed) for r in separator_scan.scan(blocks, 9, 4).collect())
    assert got == [("a.bin", 0, 0, 2, True), ("a.bin", 1, 3, 0, True), ("a.bin", 2, 4, 1, False), ("b.bin", 0, 0, 3, False), ("c.bin", 0, 0, 0, True)]


# --- 1: chat -------------------------------------------------------------------------------

def test_chat_calls(spark):
    calls = [
        (1, "a", "search", '{"turn": 1, "text": "x"}', None), (1, "c", "search", '{"text":"z","turn":"3"}', "b"), (1, "b", "search", '{"text": "é\\"", "turn": 2, "n": {"b": 1, "a": [1, null]}}', "a"),
        (1, "a", "search", '{"turn": 9, "text": "y"}', None), (2, "a", "other", "{}", "gone"), (2, "p", "search", "{broken", "q"), (2, "q", "search", None, "p"),
        (None, None, "search", '{"text": "t", "turn": 1}', None), (3, "s", None, "[1]", "s"), (4, "m", "search", '{"turn": 1}', None),
    ]
    chain = [(9, f"k{i}", "search", f'{{"text": "t", "turn": {i}}}', f"k{i - 1}" if i else None) for i in range(50)]
    results = [(1, "a", "first"), (1, "a", "second"), (1, "b", None), (None, None, "of none"), (8, "x", "no call")]
    calls = spark.createDataFrame(calls + chain, "conv_id long, call_id string, name string, arguments string, after string").selectExpr("*", "1 AS depth", "'q' AS content")
    results = spark.createDataFrame(results, "conv_id long, call_id string, content string").selectExpr("*", "2 AS name")
    got = {(r.conv_id, r.call_id): r for r in chat_format.link_calls(calls, results, queries.TOOL_SCHEMAS).collect()}
    assert len(got) == 9 + 50
    assert [got[1, c].depth for c in "abc"] == [0, 1, 2] and [got[9, f"k{i}"].depth for i in range(50)] == list(range(50))
    assert got[1, "a"].message == '{"arguments":{"text":"x","turn":1},"content":"first","id":"a","name":"search"}'
    assert json.loads(got[1, "b"].message) == {"arguments": {"n": {"a": [1, None], "b": 1}, "text": 'é"', "turn": 2}, "content": None, "id": "b", "name": "search"}
    assert got[1, "b"].has_result and not got[1, "c"].has_result and got[None, ""].has_result
    assert got[1, "a"].error is None and got[1, "c"].error == "turn is not BIGINT" and got[4, "m"].error == "text is missing"
    assert got[2, "a"].error == "unknown tool" and got[2, "a"].depth == 0
    assert [got[2, c].error for c in "pq"] == ["circle"] * 2 and got[3, "s"].error == "circle" and got[2, "p"].depth is None
    assert chat_format.link_calls(calls.limit(0), results, queries.TOOL_SCHEMAS).collect() == []
    assert chat_format.link_calls(calls, results.limit(0), queries.TOOL_SCHEMAS).count() == 59


def test_every_call_and_result_is_kept(spark, tmp_path):
    rows = [
        (1, 0, "user", "ask"), (1, 0, "user", "ask otherwise"), (1, 0, "user", "ask"), (1, 1, "assistant", "one"), (1, 1, "assistant", "two"), (1, 1, "assistant", None),
        (1, 2, "user", "more"), (1, 3, "assistant", "more of it"), (2, 5, "assistant", "to nobody"), (3, 0, "user", "open"),
    ]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op1_tool_call_linking(spark, str(tmp_path)).collect()
    shown = sorted([(r.conv_id, r.call_id, json.loads(r.message)["arguments"].get("text"), json.loads(r.message)["content"], r.depth, r.has_result) for r in got], key=str)
    assert shown == sorted([
        (1, "call_0", "ask", "one", 0, True), (1, "call_0", "ask otherwise", "one", 0, True), (1, "call_0", None, "two", None, True), (1, "call_0", None, None, None, True),
        (1, "call_2", "more", "more of it", 1, True), (2, "call_4", None, "to nobody", None, True), (3, "call_0", "open", None, 0, False)], key=str)
    assert {r.error for r in got if (r.conv_id, r.call_id) == (1, "call_0")} == {"repeated id"}
    assert [r.error for r in got if r.conv_id == 2] == ["result without a call"]
    assert not {r.error for r in got if r.conv_id == 3 or r.call_id == "call_2"} & {"repeated id", "result without a call"}
    calls = spark.createDataFrame([(1, None, "search", "{}", None), (1, "", "search", "{}", None)], "conv_id long, call_id string, name string, arguments string, after string")
    results = spark.createDataFrame([(1, None, "of null"), (1, "", "of empty")], "conv_id long, call_id string, content string")
    got = chat_format.link_every(calls, results, queries.TOOL_SCHEMAS).collect()
    assert {(r.call_id, json.loads(r.message)["content"]) for r in got} == {(None, "of null"), ("", "of empty")}
