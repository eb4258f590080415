"""Decontamination, url rules, quality, mixing, archives, scoring and surrogates."""

import io
import re
import tracemalloc
from types import SimpleNamespace
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pytest

from strataq.llm import decontaminate, masked_lm, mixing, quality, queries, surrogates, url_filter, warc

DATA = "/root/testdata/sf0.001"


def docs(spark, rows, schema="doc_id long, text string, source string, score double"):
    return spark.createDataFrame([(*r, 0.5) if len(r) == 3 else (*r, None, 0.5) for r in rows], schema)


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma"


def test_decontaminate(spark):
    w = ITEM.split()
    swapped = " ".join("x" if k in (5, 12) else x for k, x in enumerate(w))
    far = " ".join("x" if k % 2 else x for k, x in enumerate(w))
    rows = [(1, f"some words first {ITEM.upper()}, and more"), (2, swapped), (3, far), (4, None), (5, ""), (6, "alpha beta gamma"), (7, ITEM), (7, ITEM), (None, ITEM), (8, "filler " * 5000 + ITEM)]
    bench = spark.createDataFrame([(10, ITEM), (11, "too short"), (12, None)], "item_id long, text string")
    for inline in (200_000, 0):
        got = decontaminate.decontaminate(docs(spark, rows), bench, inline_seeds=inline).collect()
        assert sorted((r.id or 0, r.item, r.matched) for r in got) == [(0, 10, 18), (1, 10, 18), (2, 10, 16), (7, 10, 18), (8, 10, 18)]
    twice = bench.union(bench)
    assert decontaminate.decontaminate(docs(spark, rows), twice).count() == 5
    assert sorted(r.doc_id for r in decontaminate.drop_contaminated(docs(spark, rows), bench).collect()) == [3, 4, 5, 6]
    assert decontaminate.decontaminate(docs(spark, []), bench).count() == 0
    assert decontaminate.decontaminate(docs(spark, rows), bench.limit(0)).count() == 0


def test_decontaminate_short_and_substituted_items(spark):
    """Against an alignment of each item at every position, without seeds."""
    rng = np.random.default_rng(5)
    items = {n: [f"i{n}w{k}" for k in range(n)] for n in (1, 3, 5, 6, 8, 10, 11, 12, 15, 18, 25, 150)}
    texts = []
    for n, w in items.items():
        spots = [()] + [tuple(rng.choice(n, min(k, n), replace=False)) for k in (n // 6, n // 6 + 1, n // 3) for _ in range(6)] + [tuple(range(3, n, 4))]
        spots += [(k,) for k in range(n)] if n <= 12 else []
        for spot in spots:
            texts.append(" ".join(["before"] * int(rng.integers(0, 9)) + ["x" if k in spot else x for k, x in enumerate(w)] + ["after"] * int(rng.integers(0, 9))))
    want = set()
    for d, t in enumerate(texts):
        words = t.split()
        for n, w in items.items():
            for p in range(-n + 1, len(words)):
                equal = [0 <= p + k < len(words) and words[p + k] == x for k, x in enumerate(w)]
                cur = best = 0
                for e in equal:
                    cur = max(0, cur + (1 if e else -2))
                    best = max(best, cur)
                if best >= 10 or sum(equal) >= n - n // 6:
                    want.add((d, n, best, sum(equal)))
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string")
    table = docs(spark, list(enumerate(texts)))
    for inline in (200_000, 0):
        assert {tuple(r) for r in decontaminate.decontaminate(table, bench, inline_seeds=inline).select("id", "item", "score", "matched").collect()} == want


def test_decontaminate_long_item(spark):
    """An item of 50,000 words costs seeds in proportion to them, and one alignment where it is copied."""
    w = [f"v{k * 7919 % 60_000}" for k in range(50_000)]
    bench = spark.createDataFrame([(1, " ".join(w)), (2, " ".join(f"q{k}" for k in range(300)))], "item_id long, text string")
    table = docs(spark, [(1, "x " + " ".join(w)), (2, " ".join(w[100:130])), (3, "nothing of it"), (4, " ".join(f"q{k}" for k in range(300)))])
    assert decontaminate.item_seeds(decontaminate.benchmark_items(bench, "item_id", "text")).count() == 49_996 + 296
    got = decontaminate.decontaminate(table, bench).collect()
    assert sorted((r.id, r.item, r.score, r.matched) for r in got) == [(1, 1, 50_000, 50_000), (2, 1, 30, 30), (4, 2, 300, 300)]


def test_drop_contaminated_judges_rows_that_share_an_identifier(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs(spark, [(1, ITEM), (1, "another text"), (None, ITEM), (None, None)]), bench)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == [(1, "another text"), (None, None)] and kept.columns == ["doc_id", "text", "source", "score"]


def rule(host, path):
    fit = [(len(h + p), h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[1:] if fit else (None, None)


def test_urls(spark):
    urls = ["http://Example.COM/en/7x?q", "https://a.example.com/en/1", "http://x.net/de/8", "https://m.example.net/de/8#z", "http://notcom/en/", None, "", "no scheme/en/", "http://y.org?x=/es/",
            "http://spam-farm.example.com/fr/1", "http://blog.gardening.example.org/posts/x", "http://y.org/es/" + "z" * 5000, "a://b://c/d"]
    pages = spark.createDataFrame([(k, u, "h", "r") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    assert len(got) == len(urls)
    for k, u in enumerate(urls):
        m = re.search(r"://([^/?#]*)([^?#]*)", u or "", re.S)
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        assert (got[k].host, got[k].path) == (host, path)
        text, verdict = rule(host, path)
        assert got[k].rule == text and got[k].verdict in ("allow", "block") and verdict in (None, got[k].verdict)
    assert (got[9].verdict, got[10].verdict) == ("block", "allow")
    assert urlsplit(urls[0]).netloc.lower() == got[0].host
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_url_model(spark):
    """Learnt from a table that is an input: another table, other verdicts."""
    table = url_filter.labelled_urls(spark)
    assert table.count() == 1200 and table.where("label = 1").count() == 600 and url_filter.held_out_accuracy(table) > 0.9
    assert table.where("url like '%example.com%' or url like '%example.org%' or url like '%example.net%'").count() == 0
    pages = spark.createDataFrame([(1, "http://cheap-casino.shop/win"), (2, "http://village-library.org/guide/3"), (3, "http://ththan.nowhere/7"), (4, "http://apples.one/x")], "page_id long, url string")
    verdicts = lambda t: {r.page_id: r.verdict for r in url_filter.judge_urls(pages, labelled=t).collect()}
    assert verdicts(None) == {1: "block", 2: "allow", 3: "allow", 4: "allow"}
    own = spark.createDataFrame([(f"http://{w}{k}.one/x", int(w == "apples")) for k in range(20) for w in ("apples", "pears")] + [(None, None), ("http://u", None)], "url string, label int")
    assert verdicts(own)[4] == "block"


def test_quality(spark):
    d = spark.read.parquet(f"{DATA}/documents.parquet")
    lab = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op3_quality(spark, "/root/testdata/sf0.01")
    held = got.join(lab, "doc_id").where("held_out")
    assert got.count() == d.count() and got.where("score < 0 or score > 1 or score is null").count() == 0
    assert held.where("predicted = quality").count() / held.count() > 0.9
    none = quality.fit(docs(spark, [(1, None), (2, "")]), lab.limit(0))
    assert [r.s for r in quality.score(docs(spark, [(1, None), (2, "a b")]), none, out_col="s").collect()] == [0.5, 0.5]
    assert quality.score(docs(spark, []), none, out_col="s").count() == 0


def test_word_vectors_and_pooling_by_plain_loops(spark):
    """The vectors of all words and the pooled vector of each text against loops over words."""
    texts = ["one two three two one", None, "", "three", "Two one four five one two", "one two three two one"]
    got = quality.word_vectors(docs(spark, list(enumerate(texts))).repartition(3))
    cell = lambda w: int(quality._tokens([np.frombuffer(w.encode(), np.uint8)])[0][0])
    end = lambda w: int(quality._endings([np.frombuffer(w.encode(), np.uint8)])[0])
    (at, sign), (at2, sign2) = quality._index_vectors(11, quality.WORDS), quality._index_vectors(12, quality.WORDS)
    total, seen = np.zeros((quality.WORDS, quality.DIM)), np.zeros(quality.WORDS)
    for t in texts:
        w = (t or "").split()
        for k, x in enumerate(w):
            seen[cell(x)] += 1
            for j in range(quality.NONZERO):
                total[cell(x), at2[j][end(x)]] += sign2[j][end(x)]
                for other in [*w[max(0, k - 2): k], *w[k + 1: k + 3]]:
                    total[cell(x), at[j][cell(other)]] += sign[j][cell(other)]
    used = seen > 0
    v = total[used] / seen[used][:, None]
    want = (v - v.mean(0)) / (v.std(0) + 1e-9)
    assert np.allclose(got[used], want, atol=1e-4) and not got[~used].any()
    pooled = quality.pool([np.frombuffer((t or "").encode(), np.uint8) for t in texts], got)
    for t, p in zip(texts, pooled, strict=True):
        x = np.array([got[cell(w)] for w in (t or "").split()]).reshape(-1, quality.DIM)
        if not len(x):
            assert not p.any()
            continue
        step = np.sqrt((np.diff(x, axis=0) ** 2).mean(0)) if len(x) > 1 else np.full(quality.DIM, 2**0.5)
        assert np.allclose(p, np.concatenate((x.mean(0), x.std(0), step, [len(x) / (len(x) + quality.PRIOR_WORDS)])), atol=1e-3)


def test_word_vectors_take_little_memory_for_each_byte(monkeypatch):
    """Two of these workers share an executor with its JVM."""
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: SimpleNamespace(partitionId=lambda: 0))
    batch = pa.RecordBatch.from_arrays([pa.array(["some words of a longer text, again and again " * 40] * 4000)], names=["text"])
    tracemalloc.start()
    out = list(quality._gather(11)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    seen = np.concatenate([np.frombuffer(x, np.float32) for x in out[0].column(2).to_pylist()]).reshape(quality.WORDS, -1)[:, -1]
    assert seen.sum() == 4000 * 40 * 9
    assert peak < 15 * batch.nbytes


def test_labelled_rows_are_bounded(spark):
    """An identifier that stands on many rows gives its text once, and no more than the bound are collected."""
    lab = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    table = docs(spark, [(1, "good words here")] * 50 + [(2, f"bad {k}") for k in range(50)])
    seen = []
    real = quality.fit_network
    try:
        quality.fit_network = lambda x, y, vectors: seen.append((len(x), y.sum())) or real(x, y, vectors)
        quality.fit(table, lab)
        quality.fit(table, lab, max_labelled=10)
    finally:
        quality.fit_network = real
    assert 40 < seen[0][0] <= 51 and seen[0][1] == 1 and seen[1][0] <= 10  # texts of one vector count once


def test_network_learns():
    rng = np.random.default_rng(0)
    x = np.hstack((rng.normal(size=(2000, quality.POOLED - 1)), np.ones((2000, 1)))).astype(np.float32)
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    m = quality.fit_network(x, y, np.zeros(1))
    assert ((m.score(x) > 0.5) == y).mean() > 0.8 and 0.25 <= m.temperature <= 8


def test_mixing(spark):
    rows = [(k, "w " * (k % 37 + 1), f"s{k % 3}" if k % 5 else None) for k in range(900)] + [(901, None, "s0"), (902, "", "empty"), (5, "w " * 6, None), (None, "a b", "s1")]
    a = mixing.mix(docs(spark, rows), block=64).collect()
    b = mixing.mix(docs(spark, rows).repartition(7), block=64).collect()
    key = lambda r: (r.id is None, r.id or 0, r.size, r.copies)
    assert len(a) == len(rows) and [key(r) for r in sorted(a, key=key)] == [key(r) for r in sorted(b, key=key)]
    size, target, taken = {}, {}, {}
    for r in a:
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
        size[r.source] = size.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    names = sorted((s for s in size if s is not None)) + [None]
    weight, rest, open_, want = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}, 1.5 * sum(size.values()), set(names), {}
    while over := [s for s in open_ if rest * weight[s] / sum(weight[x] for x in open_) > 2 * size[s]]:
        want |= {s: 2 * size[s] for s in over}
        open_ -= set(over)
        rest = 1.5 * sum(size.values()) - sum(want.values())
    want |= {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
    for s in names:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 38
    assert mixing.mix(docs(spark, [])).count() == 0


def test_mixing_keeps_inclusion_probabilities(spark):
    """Over seeds, a document is taken as often as its source's target over its size says, but for the twelve of a landing."""
    rows = [(k, "w " * (k * 7 % 23 + 1), f"s{k % 2}") for k in range(400)]
    table, share = docs(spark, rows), {}
    taken = np.zeros(400)
    for seed in range(12):
        for r in mixing.mix(table, seed=seed, block=64).collect():
            taken[r.id] += r.copies / 12
            share[r.source] = r.target / r.source_size
    for s in (0, 1):
        got = taken[np.arange(400) % 2 == s]
        assert got.mean() == pytest.approx(share[f"s{s}"], rel=0.02)
        p = share[f"s{s}"] % 1
        assert p in (0.0,) or (np.abs(got - share[f"s{s}"]) > 4.5 * (p * (1 - p) / 12) ** 0.5).mean() < 0.03


def test_mixed_keeps_texts_and_columns(spark):
    rows = [(k, "w " * (k % 5 + 1), "a") for k in range(40)] + [(7, "w w w", "a")] * 3 + [(None, None, None), (50, "w", "b")]
    table = docs(spark, rows)
    out, plan = mixing.mixed(table), mixing.mix(table)
    assert out.columns == ["doc_id", "text", "source", "score", "size", "source_size", "target", "copies", "taken"]
    got = out.collect()
    assert sum(r.taken for r in got) == sum(r.taken for r in plan.collect()) and all(r.taken == r.copies * len(r.text.split()) for r in got)
    assert len({(r.doc_id, r.text, r.source) for r in got}) == len(got)


def test_archive_round_trip():
    records = [warc.record_bytes(k, f"http://a/{k}\r\n", f"<p>{k} some page text</p>".encode() * (k % 9)) for k in range(300)] + [warc.record_bytes(None, None, b"", 3, True)]
    data = b"".join(warc.archive_parts(records))
    assert int.from_bytes(data[:4], "little") == warc.DICT_MAGIC
    got = list(warc.read_records(io.BytesIO(data)))
    assert len(got) == 301 and got[8][1].endswith(b"<p>8 some page text</p>" * 8) and got[300][0]["X-Refers-To-Page-Id"] == "3"
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(b"not an archive")))
    assert list(warc.read_records(io.BytesIO(b"".join(warc.archive_parts([records[1]])))))


def test_warc(spark):
    rows = [(1, "http://a", "<p>x</p>", 1), (2, "http://b", "<p>x</p>", 1), (3, None, None, 1), (4, "u", "", 1), (5, "http://c", "é" * 40_000, 1), (None, "d", "<p>x</p>", 1), (1, "http://a", "<p>x</p>", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    manifest = warc.write_archives(pages, archive_bytes=10_000)
    got = warc.read_archives(manifest, with_payload=True).collect()
    want = [(None, 8, "revisit", 1), (1, 8, "response", None), (1, 8, "response", None), (2, 8, "revisit", 1), (3, 0, "response", None), (4, 0, "revisit", 3), (5, 80_000, "response", None)]
    assert sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got), key=str) == sorted(want, key=str)
    assert next(bytes(r.payload) for r in got if r.page_id == 5) == ("é" * 40_000).encode()
    assert warc.read_archives(warc.write_archives(pages.limit(0))).count() == 0
    big = warc.read_archives(warc.write_archives(pages, min_bytes=100)).where("record_type = 'revisit'")
    assert big.count() == 0


def test_masked_lm(spark):
    rows = [(k, "the cat sat on the mat and the dog sat on the rug " * 6) for k in range(60)] + [(100, "mat the on cat rug sat dog and the the on sat the " * 6), (101, None), (102, ""), (103, "one")]
    model = masked_lm.fit(docs(spark, rows))
    got = {r.id: r for r in masked_lm.score(docs(spark, rows), model).collect()}
    assert got[0].mean_logprob > got[100].mean_logprob and got[101].pll == 0 and got[102].mean_logprob is None and got[103].n_words == 1
    line, at, _ = masked_lm._windows([np.frombuffer(rows[0][1].encode(), np.uint8)])
    one = []
    (table, bias, w), freq = model
    for i in at:
        h = np.tanh(bias + sum(table[j][line[i + p]] for j, p in enumerate(masked_lm.PLACES)))
        x, cell = h @ w + freq[line[i] // 32], line[i]
        one.append(sum(x[c] - np.log(np.exp(x[a:z]).sum()) for c, a, z in zip((cell // 512, 16 + cell // 32 % 16, 32 + cell % 32), (0, 16, 32), (16, 32, 64), strict=True)))
    assert got[0].pll == pytest.approx(sum(one), rel=1e-4)
    assert masked_lm.score(docs(spark, []), masked_lm.fit(docs(spark, []))).count() == 0


def test_masked_lm_probabilities_of_all_cells_add_up():
    rng = np.random.default_rng(2)
    params = [rng.normal(0, 1, p.shape).astype(np.float32) for p in masked_lm.start()]
    freq = masked_lm._frequencies(rng.integers(0, 9, masked_lm.WORDS).astype(float))
    line, at, _ = masked_lm._windows([np.frombuffer(b"a b c d e", np.uint8)])
    rows = np.tile(line, (masked_lm.WORDS, 1))
    rows[:, at[2]] = np.arange(masked_lm.WORDS)
    got = masked_lm.log_probs(params, freq, rows.reshape(-1), np.arange(masked_lm.WORDS) * len(line) + at[2])
    assert np.exp(got).sum() == pytest.approx(1, rel=1e-4)


def test_masked_lm_step_follows_the_slope():
    """One step of training moves each parameter against the slope of the mean loss, found by small differences."""
    rng = np.random.default_rng(4)
    params = [rng.normal(0, 0.3, p.shape) for p in masked_lm.start()]
    freq = masked_lm._frequencies(rng.integers(0, 5, masked_lm.WORDS).astype(float)).astype(float)
    line, at, _ = masked_lm._windows([np.frombuffer(t, np.uint8) for t in (b"one two three one two", b"three four")])
    loss = lambda p: -masked_lm.log_probs(p, freq, line, at).mean()
    after, squares = [p.copy() for p in params], [np.zeros_like(p) for p in params]
    masked_lm.train(after, freq, line, at, squares, rate=1e-3)
    assert loss(after) < loss(params)
    for k, p in enumerate(params):
        moved = np.argwhere(np.abs(after[k] - p) > 0)
        for at_ in map(tuple, moved[rng.permutation(len(moved))[:25]]):
            more, less = [q.copy() for q in params], [q.copy() for q in params]
            more[k][at_] += 1e-5
            less[k][at_] -= 1e-5
            slope = (loss(more) - loss(less)) / 2e-5
            assert squares[k][at_] == pytest.approx(slope * slope, rel=1e-2, abs=1e-9) and (after[k][at_] < p[at_]) == (slope > 0)


def test_masked_lm_trains_on_every_word(spark, monkeypatch):
    """Every word of every document is a target once, whatever the blocks."""
    texts, seen = ["one", None, "two words", "a b c", "", "the cat sat on the mat"], []
    monkeypatch.setattr(masked_lm, "train", lambda params, freq, line, at, squares: seen.extend(line[at]))
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: type("T", (), {"partitionId": lambda self: 0})())
    held = type("B", (), {"value": (masked_lm.start(), np.zeros(masked_lm.WORDS))})()
    batch = pa.RecordBatch.from_arrays([pa.array([0, 0, 0, 1, 2, 2]), pa.array(texts, pa.string())], names=["block", "text"])
    out = pa.Table.from_batches(masked_lm._learn(held)(iter([batch]))).to_pylist()
    line, at, _ = masked_lm._windows([np.frombuffer((t or "").encode(), np.uint8) for t in texts])
    assert len(at) == 12 and sorted(seen) == sorted(line[at])
    assert sum(r["n"] for r in out if r["word"] is not None) == 12 and {r["block"] for r in out if r["word"] is not None} == {0, 1, 2}
    assert np.frombuffer(next(r["sums"] for r in out if r["piece"] == masked_lm.PIECES - 1))[-1] == 12


def test_masked_lm_scores_do_not_depend_on_layout(spark, monkeypatch):
    monkeypatch.setattr(masked_lm, "BLOCK", 40_000)
    table, scores = spark.read.parquet(f"{DATA}/documents.parquet"), []
    for n in (1, 4, 8):
        dealt = table.repartition(n)
        model = masked_lm.fit(dealt)
        assert model.blocks > 8
        scores.append({r.id: r.pll for r in masked_lm.score(dealt, model, fitted=n > 1).collect()})
    assert scores[0].keys() == scores[1].keys() and all(scores[0][k] == pytest.approx(s[k], rel=1e-3, abs=1e-6) for s in scores[1:] for k in s)


def test_masked_lm_beats_a_unigram_on_other_texts(spark, monkeypatch):
    """Over the same cells and vocabulary, on documents that it wasn't fitted to."""
    from pyspark.sql import functions as F

    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    part = F.crc32(F.col("doc_id").cast("string")) % 5
    model = masked_lm.fit(table.where(part > 0))
    plain = masked_lm.Model(([np.zeros_like(p) for p in model[0]], model[1]))
    plain.vocab, plain.rest = model.vocab, model.rest
    other = table.where(part == 0)
    sums = [masked_lm.score(other, m).agg(F.sum("pll"), F.sum("n_words")).first() for m in (model, plain)]
    assert sums[0][1] == sums[1][1] > 10_000 and sums[0][0] / sums[0][1] > sums[1][0] / sums[1][1] + 0.02


def test_masked_lm_scores_words_that_share_a_cell(spark):
    cell = lambda w: masked_lm._windows([np.frombuffer(w.encode(), np.uint8)])[0][2]
    rare, unseen = [w for k in range(40_000) if cell(w := f"w{k}") == cell("cat")][:2]
    rows = [(k, "the cat sat") for k in range(50)] + [(50, f"the {rare} sat"), (51, f"the {rare} sat")]
    model = masked_lm.fit(docs(spark, rows))
    assert model.vocab.count() == 4 and {round(r.logp, 4) for r in model.vocab.collect()} == {0.0, round(np.log(50 / 52), 4), round(np.log(2 / 52), 4)}
    got = {r.id: r.pll for r in masked_lm.score(docs(spark, [*rows, (52, f"the {unseen} sat"), (52, f"the {unseen} sat")]), model).collect()}
    assert got[0] - got[50] == pytest.approx(np.log(50 / 2), rel=1e-4) and got[50] == pytest.approx(got[51])
    assert got[50] - got[52] == pytest.approx(np.log(2 / masked_lm.FLOOR), rel=1e-4)


@pytest.mark.parametrize("text", ["Password: hunterabc", "API_KEY=qwertyuiop", "access_token=qwertyuiop", "client_secret: qwertyuiop", '{"password": "qwertyuiop"}', "apiKey = 'qwertyuiop'"])
def test_secrets_in_any_spelling(text):
    new, found = surrogates.replace(text, b"k")
    assert [t for t, *_ in found] == ["secret"] and "qwertyuiop" not in new and "hunterabc" not in new and len(new) == len(text)
    assert surrogates.replace("a notoken: qwertyuiop", b"k")[1] == []


def test_surrogates(spark):
    text = "Write to Ann.Lee@Mail.example.com or ann.lee@mail.example.com, +1 (017) 555-7713, 97.51.17.173, 4012-8888-8888-1881, Mrs Julia Smith, Господин Иван Петров, password=b7db7aa4a5fc78 v4.0."
    new, found = surrogates.replace(text, b"k")
    kinds = {t for t, *_ in found}
    assert kinds == {"email", "phone", "ip", "card", "name", "secret"}
    for _, entity, other, _ in found:
        assert entity not in new and len(entity.split()) == len(other.split())
    a, b = [o for t, _, o, _ in found if t == "email"]
    assert a.lower() == b.lower() and a != b and a[0].isupper()
    assert new.startswith("Write to ") and new.endswith(" v4.0.") and "Mrs " in new
    given = next(o for t, e, o, _ in found if "Julia" in e).split()[1]
    assert given in surrogates.NAMES["f", "latin"] and any(n in new for n in surrogates.NAMES["m", "cyrillic"])
    card = [int(c) for c in next(o for t, _, o, _ in found if t == "card") if c.isdigit()]
    assert surrogates._luhn(card[:-1]) == card[-1]
    rows = [(k, f"user{k}@mail{k % 7}.example.com and {10 + k % 200}.1.2.{k % 250} and +1 ({k:03d}) 555-0000") for k in range(900)] + [(901, None), (902, ""), (903, "plain"), (904, text * 200)]
    done = surrogates.pseudonymise(docs(spark, rows))
    assert done.count() == 904 and surrogates.collisions(done).count() == 0
    assert {r.id: r.text for r in done.where("id in (901, 902, 903)").collect()} == {901: None, 902: "", 903: "plain"}
    assert surrogates.pseudonymise(docs(spark, [])).count() == 0


def test_surrogates_read_long_tokens_in_linear_time():
    import time

    for token in ("a1" * 1_000_000, "a." * 1_000_000, "x@" + "a-" * 1_000_000, "@" * 1_000_000, "password" * 200_000, "token" + " " * 1_000_000, "1 " * 500_000, "Aa" * 500_000, "+1 " * 300_000):
        began = time.perf_counter()
        surrogates.replace("Ann@x.org " + token + " bob@y.org", b"k")
        assert time.perf_counter() - began < 10, token[:9]
    began = time.perf_counter()
    new, found = surrogates.replace("a1" * 1_000_000, b"k")
    assert time.perf_counter() - began < 2 and found == []


def test_surrogates_over_whole_documents(spark):
    """Each entity has one surrogate, no two share one, and titles, given names and endings keep their gender and script."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in table.select("doc_id", "text").collect()}
    own, made, n = {}, {}, 0
    plain = lambda e: re.sub(r"[^\w]+", " ", e).lower()
    for r in surrogates.pseudonymise(table).collect():
        at, out = 0, []
        for e in r.entities:
            assert texts[r.id][e.start: e.start + len(e.entity)] == e.entity and e.surrogate != e.entity
            out += [texts[r.id][at: e.start], e.surrogate]
            at = e.start + len(e.entity)
            assert own.setdefault((e.type, plain(e.entity)), plain(e.surrogate)) == plain(e.surrogate)
            assert made.setdefault((e.type, plain(e.surrogate)), plain(e.entity)) == plain(e.entity)
            n += 1
            if e.type == "name":
                for a, b in zip(e.entity.split(), e.surrogate.split(), strict=True):
                    if a in surrogates._OWN.listed:
                        assert surrogates._OWN.listed[a][0] == surrogates._OWN.listed[b][0]
                    assert a[0].isupper() == b[0].isupper() and (a[0] < "\u0400") == (b[0] < "\u0400")
            else:
                assert len(e.entity) == len(e.surrogate) or e.type == "ip"
        assert "".join([*out, texts[r.id][at:]]) == r.text
    assert n > 100


def test_surrogates_of_unlisted_names():
    for text, name in (("My name is Fiona Braithwaite.", "Fiona"), ("mein Name ist Jorgo Weber", "Jorgo"), ("меня зовут Зинаида Котова", "Зинаида"), ("Name: Orlando Furst", "Orlando"), ("Dr Quentin Moss", "Quentin")):
        new, [(kind, entity, other, _)] = surrogates.replace(text, b"k")
        assert kind == "name" and name in entity and name not in new
        first = other.split()[-2]
        assert first[-1] == name[-1] or name == "Quentin"  # an ending that shows the gender stays
    names = {("f", "latin"): ["Ada", "Eve"], ("m", "latin"): ["Abe", "Eli"]}
    assert surrogates.replace("Eve Stone met James Dean", b"k", surrogates.Names(names))[0].startswith("Ada ") and "James Dean" in surrogates.replace("Eve Stone met James Dean", b"k", surrogates.Names(names))[0]


def test_surrogates_keep_coreference_and_distinctness():
    key = b"k"
    one = {surrogates.replace(f"{before}Smith came.", key)[0].split()[-2] for before in ("Mr ", "Mrs ", "Ms. ", "Mr John ", "Mary ", "Dr John ")}
    assert len(one) == 1 and "Smith" not in one
    ivan = surrogates.replace("Господин Петров и Госпожа Петрова", key)[0].split()
    assert ivan[1].endswith("ов") and ivan[-1].endswith("ова") and ivan[1] not in ("Петров", ivan[-1])
    for kind, every in (("value", [f"{a}{b}{c}x1a" for a in "abz" for b in "e01" for c in "fgh"] + [f"{k:06x}" for k in range(0, 1 << 24, 40_009)]), ("ip", [f"1.2.{k}.{j}" for k in range(9) for j in range(9)]),
                        ("name", [f"{a}{b}" for a in ("Li", "Lo", "Ka") for b in "aeioubcd"]), ("card", [f"{k:016d}" for k in range(300)]), ("ssn", ["123-45-6789", "000-00-0000"]),
                        ("email", [f"{a}.{b}@x.org" for a in "abcdefgh" for b in "aeiou1"]), ("phone", ["+1 (017) 555-7713", "+2 (017) 555-7713"])):
        got = [surrogates.surrogate(kind, x, key) for x in every]
        assert len(set(got)) == len(every) and not any(a == b for a, b in zip(got, every, strict=True))
        assert [surrogates._turned(kind, y, key, True) for y in got] == every
        if kind == "value":
            assert [surrogates._is_hex(x) for x in every] == [surrogates._is_hex(y) for y in got]
    assert surrogates.surrogate("name", "\u212aarl", key)[0] == "\u212a"  # a Kelvin sign isn't a K
    assert surrogates.surrogate("email", "_@_.org", key) == "_@_.org"


def test_collision_check_raises(monkeypatch):
    monkeypatch.setattr(surrogates, "_turned", lambda kind, text, key, back, names: "same")
    with pytest.raises(ValueError):
        surrogates.surrogate("ssn", "111-22-3333", b"another key")


def test_permutation_is_one_to_one():
    sizes = [10, 6, 20]
    every = {tuple(surrogates.permute([a, b, c], sizes, b"k", "t")) for a in range(10) for b in range(6) for c in range(20)}
    assert len(every) == 1200


def test_pipeline(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs_, steps = spark.read.parquet(f"{d}/documents.parquet"), []
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        out = f(spark, docs_, d)
        if k < 4:
            assert out.columns == docs_.columns
            steps.append(set(r.doc_id for r in out.select("doc_id").collect()))
            docs_ = out
    assert all(a >= b for a, b in zip(steps, steps[1:], strict=False))
    assert {r.doc_id for r in corpus_pipeline.run(spark, d).collect()} <= steps[-1]
