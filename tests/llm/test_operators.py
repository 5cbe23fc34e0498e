"""Every operator against plain Python, on a table of edge cases: nulls, empty and very long
texts, ties, repeated rows, and extra columns whose names clash with results."""

import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ecoflux.llm import chat_format, decontaminate, divergence, langid, license_scan, line_dedup, merkle, mixing, quality, simhash, substring_dedup, suffix_dedup, topk
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, kept string, fingerprint string, id int, tk int, h1 int, row int, score int"


def say(rng, n, vocabulary=400):
    return " ".join(rng.choice("Abcde") + str(rng.randrange(vocabulary)) for _ in range(n))


def corpus():
    rng = random.Random(5)
    line, passage = "A Shared line that many documents hold, ÄÖ.", say(rng, 30)
    near = say(rng, 300)
    texts = [None, "", "   \n\t ", "one", "one two", "ÉCOLE école ÉCOLE", "a " * 70 + "b", "x\x00y \x7f\x1f z", line, "    word word"]
    texts += [f"{say(rng, 8)}\n  {line.upper() if i % 2 else line}\t\n{say(rng, 9)}\n{line}" for i in range(6)]
    texts += [f"{say(rng, 15)} {passage} {say(rng, 15)}" for _ in range(4)]
    texts += [near, near.lower(), near + " end", near, near.replace("\n", " ") + " END end"]
    texts += [say(rng, 30000, 5000), say(rng, 5), say(rng, 200) + "\n" + passage + "\n" + passage, "same words " * 40]
    return list(enumerate(texts, 3))


def frame(spark, rows):
    full = [(i, t, "en", f"s{(i or 0) % 4}" if (i or 1) % 5 else None, len(t or ""), *["mine"] * 3, *[7] * 5) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark, corpus()).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


ITEMS = [(1, "b " * 12), (2, "a a a a a a a a a a"), (3, None), (4, " ,. "), (5, "one"), (6, "École ÉCOLE"), (6, "same words same"), (70, "same words " * 6), (71, "same words " * 6)]


def items(spark):
    rng = random.Random(5)
    passage = say(rng, 30)
    return spark.createDataFrame([*ITEMS, (8, passage), (9, passage[: len(passage) // 2].upper())], "item_id long, text string")


# ---------------------------------------------------------------- line dedup


def test_lines_equal_brute_force(docs):
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in line_dedup.line_report(docs).collect()}
    want = brute.lines(corpus())
    assert got == want and sum(w[1] for w in want.values()) > 5


@pytest.mark.parametrize("batches, fanout", [(1, 2), (3, 2), (7, 3)])
def test_lines_do_not_depend_on_batches(spark, batches, fanout):
    rng = random.Random(batches)
    rows = [(i, "\n".join(f"line number {rng.randrange(12)} of the common stock" for _ in range(rng.randrange(5)))) for i in range(60)]
    out = line_dedup.line_report(frame(spark, rows), n_batches=batches, fanout=fanout)
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in out.collect()} == brute.lines(rows)


def test_lines_keep_the_table_as_it_is(docs, empty):
    out = line_dedup.drop_repeated_lines(docs)
    assert out.schema == docs.schema or out.dtypes == docs.dtypes
    texts = {r.doc_id: r for r in out.collect()}
    assert texts[3].text is None and texts[3].kept == "mine" and texts[4].text == ""
    assert all(r.text is None or r.n_chars == len(r.text) for r in texts.values())
    assert line_dedup.drop_repeated_lines(empty).count() == 0


def test_lines_of_repeated_and_null_ids(spark):
    line = "the very same line of more than twenty characters"
    rows = [(1, line), (1, line), (None, line), (2, line), (2, "other\n" + line)]
    out = sorted((r.doc_id or 0, r.n_dropped) for r in line_dedup.line_report(frame(spark, rows)).collect())
    assert out == [(0, 0), (1, 0), (1, 0), (2, 0), (2, 0)]  # two documents only
    out = sorted((r.doc_id or 0, r.n_dropped) for r in line_dedup.line_report(frame(spark, [*rows, (9, line)])).collect())
    assert out == [(0, 1), (1, 1), (1, 1), (2, 1), (2, 1), (9, 0)]


# ---------------------------------------------------------------- decontamination


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_SEEDS, 0])
def test_leaks_equal_brute_force(spark, docs, limit):
    bench = items(spark)
    out = decontaminate.report(docs, bench, broadcast_seeds=limit).collect()
    got = {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in out}
    want = brute.leaks(corpus(), [(r.item_id, r.text) for r in bench.collect()])
    assert got == want and sum(bool(w[1]) for w in want.values()) > 6


def test_winnowing_misses_no_span(spark):
    rng = random.Random(3)
    few = [" ".join(rng.choice("ab") for _ in range(40)) for _ in range(40)]  # many equal k-grams
    rows, bench = list(enumerate(few[:25])), list(enumerate(few[25:]))
    out = decontaminate.report(frame(spark, rows), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, list(r["items"])) for r in out} == brute.leaks(rows, bench)


def test_decontaminated_keeps_clean_rows(spark, docs, empty):
    bench = items(spark)
    dirty = {i for i, w in brute.leaks(corpus(), [(r.item_id, r.text) for r in bench.collect()]).items() if w[1]}
    out = decontaminate.decontaminated(docs, bench)
    assert out.dtypes == docs.dtypes and {r.doc_id for r in out.collect()} == {i for i, _ in corpus()} - dirty
    assert decontaminate.decontaminated(empty, bench).count() == 0
    assert decontaminate.decontaminated(docs, bench.limit(0)).count() == docs.count()
    again = frame(spark, [(None, "one"), (None, "clean"), (5, "clean"), (5, "one")])
    assert sorted((r.doc_id or 0, r.text) for r in decontaminate.decontaminated(again, bench).collect()) == [(0, "clean"), (5, "clean")]


# ---------------------------------------------------------------- simhash


def test_fingerprints_and_groups_equal_brute_force(docs):
    out = simhash.near_duplicates(docs).collect()
    fps = {i: brute.fingerprint(t) for i, t in corpus()}
    assert {r.id: r.fp % (1 << 64) for r in out} == fps
    assert {r.id: r.component_id for r in out} == brute.components(fps)


def test_covering_masks_miss_no_pair():
    rng = np.random.default_rng(0)
    for level in range(4):
        masks = np.array(simhash.covering_masks(3, level), np.int64)
        for _ in range(3000):
            bits = rng.choice(64, 3, replace=False)
            diff = np.int64(sum(1 << int(b) for b in bits) - (1 << 64) * (63 in bits))
            assert ((masks & diff) == 0).any()


def test_levels_bound_every_bucket():
    masks = [[m % (1 << 64) for m in simhash.covering_masks(3, level)] for level in range(3)]
    free = [64 - (a | b | c).bit_count() for a in masks[0] for b in masks[1] for c in masks[2]]
    assert max(64 - (a | b).bit_count() for a in masks[0] for b in masks[1]) < 24 and max(free) <= 15


@pytest.mark.parametrize("bucket_rows", [2048, 32])
def test_links_of_random_fingerprints(spark, bucket_rows):
    rng = random.Random(bucket_rows)
    fps = set()
    for _ in range(30):
        x = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            fps.add(x)
            for _ in range(rng.randrange(1, 5)):
                x ^= 1 << rng.randrange(64)
    x = rng.getrandbits(64)
    fps |= {x ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(150)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    classes = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    edges = simhash.links(classes, bucket_rows=bucket_rows).collect()
    assert all((r.a ^ r.b).bit_count() <= 3 or ((r.a ^ r.b) % (1 << 64)).bit_count() <= 3 for r in edges)
    roots = {r.node: r.root for r in simhash.components(simhash.links(classes, bucket_rows=bucket_rows)).collect()}
    want = brute.components({signed(x): x for x in fps})
    groups = lambda m: sorted(sorted(k for k in want if m.get(k, k) == v) for v in {m.get(k, k) for k in want})
    assert groups(roots) == groups(want)


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(400)] + [(1000, 1001)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert len(roots) == 403 and len({roots[i] for i in range(401)}) == 1 and roots[1000] == roots[1001] != roots[0]


def test_keep_one_of_each_group(spark, docs, empty):
    want = set(brute.components({i: brute.fingerprint(t) for i, t in corpus()}).values())
    out = simhash.keep_one(docs)
    assert out.dtypes == docs.dtypes and sorted(r.doc_id for r in out.collect()) == sorted(want)
    assert simhash.keep_one(empty).count() == 0
    again = frame(spark, [(4, "some words here"), (4, "some words here"), (None, "some words here"), (5, "quite other words there"), (None, "third")])
    assert sorted((r.doc_id or 0, r.text) for r in simhash.keep_one(again).collect()) == [(0, "third"), (4, "some words here"), (5, "quite other words there")]


# ---------------------------------------------------------------- substring dedup


@pytest.mark.parametrize("chunk", [1 << 20, 50])
def test_cuts_equal_brute_force(docs, chunk):
    got = {r.id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.without_repeats(docs, chunk_words=chunk).collect()}
    want = brute.cut(corpus())
    assert got == want and sum(w[1] for w in want.values()) > 500


def test_packets_hold_any_ids():
    ids = [substring_dedup.LEAST_ID, -5, 0, 7, (1 << 63) - 1]
    hashes = [np.array([1, 2], np.uint64), np.array([2, 3], np.uint64), np.array([9], np.uint64), np.array([3, 1, 1], np.uint64), np.array([4, 9], np.uint64)]
    rows = lambda ids, hs: list(substring_dedup._chunk_rows(ids, [0] * len(ids), hs, [h % np.uint64(5) for h in hs], 256, 4, 2))
    packets = [rows([i], [h]) for i, h in zip(ids, hashes)] + [rows(ids, hashes)]
    bodies = [body for rows in packets[:-1] for kind, _, body in rows if kind == 0]
    own, h, t = substring_dedup._repeats(bodies, 0, 256, 2)
    assert list(zip(own.tolist(), h.tolist(), t.tolist())) == [(-5, 2, 2), (7, 1, 1), (7, 3, 3), (ids[4], 9, 4)]
    own, h, t = substring_dedup._repeats([b for kind, _, b in packets[-1] if kind == 0], 0, 256, 2)
    assert not len(own)  # one packet has each window once


@pytest.mark.parametrize("chunk", [1 << 20, 30])
def test_windows_with_one_first_hash_are_told_apart(monkeypatch, chunk):
    """All tasks run here, with a first hash that is the same for every second window."""
    real, sd = substring_dedup.window_hashes, substring_dedup
    weak = lambda words, width, base=sd.BASE: real(words, width, base) if base != sd.BASE else real(words, width, base) % np.uint64(2)
    monkeypatch.setattr(sd, "window_hashes", weak)
    some, extra = [(i, t) for i, t in corpus() if i is not None][:60], 8
    batch = lambda rows, names: pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names)
    docs = batch([(i, 1, t) for i, t in some], ["id", "tk", "text"])
    sent = [r for b in sd._local(20, 256, 1, chunk, extra)(iter([docs])) for r in b.to_pylist()]
    sent.sort(key=lambda r: (r["kind"], r["place"]))
    typed = lambda rows: sd._batch(*([r[k] for r in rows] for k in ("kind", "place", "body")))
    back = [r for b in sd._count(256, 1, extra)(iter([typed(sent)])) for r in b.to_pylist()]
    rows = [(0, r["kind"], None, None, r["body"], None) for r in back] + [(0, 3, i, 1, None, t) for i, t in some]
    met = batch(sorted(rows, key=lambda r: r[1]), ["place", "kind", "id", "tk", "body", "text"])
    got = {r["id"]: (r["n_words"], r["n_removed"], r["kept"]) for b in sd._cut(20, extra)(iter([met])) for r in b.to_pylist()}
    want = brute.cut(some)
    assert got == want and sum(w[1] for w in want.values()) > 100


def test_second_hash_follows_the_number_of_windows():
    assert [substring_dedup.extra_bytes(n) for n in (0, 10**8, 5 * 10**9, 17 * 10**12)] == [2, 2, 2, 5]
    for n in (10**8, 5 * 10**9, 10**11, 17 * 10**12):
        assert n * n / 2 ** (65 + 8 * substring_dedup.extra_bytes(n)) < 1e-3


def test_many_rows_without_an_id_stay_where_they_are(spark):
    t = " ".join(map(str, range(30)))
    rows = [(None, f"{t} {t} z{n % 7}") for n in range(2000)] + [(1, t + " z0"), (2, "x " + t)]
    out = substring_dedup.without_repeats(frame(spark, rows))
    got = sorted((r.id or 0, r.n_words, r.n_removed) for r in out.collect())
    assert got == [(0, 61, 30)] * 2000 + [(1, 31, 31), (2, 31, 30)]


def test_window_hashes_tell_windows_apart():
    rng = np.random.default_rng(1)
    for width in (1, 2, 3, 7, 20):
        h = rng.integers(0, 1 << 63, 6).astype(np.uint64)[rng.integers(0, 3, 500)]
        got = substring_dedup.window_hashes(h, width)
        keys = [tuple(h[i : i + width].tolist()) for i in range(len(h) - width + 1)]
        assert len(got) == len(keys) and len(set(zip(keys, got.tolist()))) == len(set(keys)) == len(set(got.tolist()))


def test_cuts_of_empty_null_and_repeated_ids(spark, empty):
    assert substring_dedup.without_repeats(empty).count() == 0
    t = " ".join(map(str, range(25)))
    out = substring_dedup.without_repeats(frame(spark, [(None, t), (3, t), (3, "new " + t), (3, t)])).collect()
    assert sorted((r.id or 0, r.n_removed) for r in out) == [(0, 0), (3, 25), (3, 25), (3, 25)]


# ---------------------------------------------------------------- mixing


def test_mix_meets_targets(docs):
    rows = mixing.schedule(docs).collect()
    size = {i: len(brute.words(t)) for i, t in corpus()}
    of = {r.doc_id: r.source for r in docs.collect()}
    sums, taken = {}, {}
    for i, s in of.items():
        sums[s] = sums.get(s, 0) + size[i]
    want = brute.shares(sums)
    for r in rows:
        s = of[r.id]
        taken[s] = taken.get(s, 0) + r.taken
        assert (r["size"], r.source_size) == (size[r.id], sums[s]) and r.target == pytest.approx(want[s])
        assert r.taken == sum(c.words for c in r.copies) <= 3 * r["size"] and all(0 <= c.position <= 1 for c in r.copies)
    assert len(rows) == len(size) and all(abs(taken[s] - want[s]) <= 1 for s in want)


def test_mix_reruns_agree_and_are_in_order(docs, empty):
    keep = lambda df: [(r.doc_id, r.taken, r.position) for r in df.collect()]
    first = keep(mixing.mixed(docs))
    assert first == keep(mixing.mixed(docs.repartition(5)))
    at = [p for _, _, p in first if p is not None]
    assert at == sorted(at) and all(p is None for _, t, p in first if not t)
    out = mixing.mixed(docs)
    assert out.dtypes[0] == ("doc_id", "bigint") and dict(out.dtypes)["size"] == "bigint" and "kept" in out.columns
    assert mixing.mixed(empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5])
def test_mix_of_few_sources(spark, n):
    rows = [(i, "w " * (i % 7), "en", f"s{i % n}", 0, *["m"] * 3, *[7] * 5) for i in range(40)]
    out = mixing.schedule(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute.shares({s: sum(i % 7 for i in range(40) if f"s{i % n}" == s) for s in {f"s{i % n}" for i in range(40)}})
    assert {round(r.target, 6) for r in out} == {round(t, 6) for t in want.values()}
    zero = spark.createDataFrame([r[:1] + (None,) + r[2:] for r in rows], SCHEMA)
    assert {(r.target, r.taken) for r in mixing.schedule(zero).collect()} == {(0.0, 0)}


def test_schedule_is_inverted(spark):
    knots = ((0.0, 0.2), (0.3, 2.0), (0.6, 0.0), (1.0, 1.0))
    shares = spark.range(101).select((F.col("id") / 100).alias("q"))
    t = np.array([r.t for r in shares.select(mixing.time_of(F.col("q"), knots).alias("t")).collect()])
    x = np.linspace(0, 1, 200001)
    w = np.interp(x, [k[0] for k in knots], [k[1] for k in knots])
    area = np.concatenate(([0], np.cumsum((w[1:] + w[:-1]) / 2))) / (w[1:] + w[:-1]).sum() * 2
    assert np.abs(np.interp(t, x, area) - np.arange(101) / 100).max() < 1e-4 and (np.diff(t) >= 0).all()


# ---------------------------------------------------------------- chat formatting


TEXTS = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[SYS]", "[ANS]", "<", "[", "\\", "s>", "INST]", "/", " ", "ok", "\n", "é"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "[/ROLE]x", "</s>"]), TEXTS), max_size=6))
def test_formatted_turns_read_back(turns):
    form = chat_format.Formatter(chat_format.INSTRUCT)
    out = "".join("".join(p for p, _ in form.format(r, t)) for r, t in turns)
    assert [(r, t) for r, t, _ in form.read(out)] == turns
    for _, t in turns:
        assert form.unescape(form.escape(t)) == t and not any(c in form.escape(t) for c in chat_format.INSTRUCT.control)


def test_a_very_long_turn_is_read_in_bounded_memory():
    form = chat_format.Formatter(chat_format.INSTRUCT)
    text = "a </s>[INST] b\n[ <" * 600_000  # 10 M characters
    formatted = "".join(piece for piece, _ in form.format("user", text))
    tracemalloc.start()
    assert form.read(formatted) == [("user", text, 0)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * len(text)
    plain = "word " * 4_000_000
    formatted = "".join(piece for piece, _ in form.format("assistant", plain))
    tracemalloc.start()
    assert form.read(formatted) == [("assistant", plain, 0)]
    assert tracemalloc.get_traced_memory()[1] < 3 * len(plain)
    tracemalloc.stop()


def test_text_that_is_not_in_the_form_is_refused():
    form = chat_format.Formatter(chat_format.INSTRUCT)
    for bad in ("x", "<s>[INST] no end", "<s>[INST] a</s>", "<s>[ANS] a</s>x", "<s>[INST] a [/INST]", "<s>[ROLE]r</s>"):
        with pytest.raises(ValueError):
            form.read(bad)


def test_conversations_read_back(spark):
    rows = [(1, 1, "assistant", "fine </s>"), (1, 0, "user", "how"), (2, 0, None, None), (2, None, "user", ""), (3, 0, "assistant", "first"), (3, 0, "assistant", "first"), (None, 5, "tool", "x")]
    rows += [(4, t, "user" if t % 2 == 0 else "assistant", "é" * t) for t in range(500)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv: r for r in chat_format.read_back(chat_format.format_turns(df)).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    for conv, r in got.items():
        own = sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is not None, x[1], x[2] or "", x[3] or ""))
        own = [(x[2] or "", x[3] or "") for x in own]
        learned = "".join(t for role, t in own if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(own), brute.sha("".join(f"{a}\n{b}\n" for a, b in own)))
        assert (r.loss_chars, r.loss_sha256) == (len(learned), brute.sha(learned))
    assert got[1].in_order and got[4].in_order and not got[2].in_order and not got[3].in_order
    assert chat_format.read_back(chat_format.format_turns(df.limit(0))).count() == 0


# ---------------------------------------------------------------- top-k


def best(vectors, k=5):
    own = {i: np.floor(256 * np.array(v, np.float64)).astype(int) for i, v in vectors}
    out = []
    for q in own:
        if q % 50 == 0:
            found = sorted((-int(own[q] @ own[c]), c) for c in own if c != q)[:k]
            out += [(q, n, c, -s) for n, (s, c) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("n, shard_rows, seed_rows", [(700, 1 << 16, 64), (700, 50, 3), (3, 1 << 16, 64), (900, 300, 1000)])
def test_top_k_equals_brute_force(spark, n, shard_rows, seed_rows):
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in np.round(rng.normal(0, 0.2, 6) * (i % 3 > 0), 2)]) for i in range(n)]  # a third are equal
    odd = [(9000, None), (9050, [1.0, None] + [0.0] * 4), (9100, [float("nan")] + [0.0] * 5), (9150, [float("inf")] + [0.0] * 5), (9200, [1.0]), (None, [0.1] * 6), (9250, [])]
    df = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<double>, score int").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=shard_rows, seed_rows=seed_rows).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == best(rows)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("scale", [3e6, 3e9, 1e10])
def test_top_k_of_large_components_and_mixed_lengths(spark, scale):
    """Scores past 2^53 are exact; past 2^63 in between as well, where those of the result fit."""
    rng = random.Random(int(scale))
    rows = [(i, [rng.uniform(-scale, scale) / 256 for _ in range(rng.choice([2, 3, 3, 3, 5]))]) for i in range(120)]
    rows += [(200 + i, []) for i in range(3)] + [(300, [1.0]), (350, [2.0]), (400, [5.0] * 9)]
    cells = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    want = []
    for q, v in cells.items():
        found = [(-sum(a * b for a, b in zip(v, w)), c) for c, w in cells.items() if c != q and len(w) == len(v) > 0 and q % 50 == 0]
        want += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(found)[:5], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    if max(abs(w[3]) for w in want) >= 1 << 63:
        with pytest.raises(Exception, match="int too|too (large|big)|overflow|OverflowError|out of bounds"):
            topk.top_k(df, F.col("vec_id") % 50 == 0).collect()
    else:
        got = topk.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=16, seed_rows=20).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(want)


def test_top_k_refuses_components_past_62_bits(spark):
    df = spark.createDataFrame([(0, [1e17, 2.0]), (1, [3e6, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="62 bits"):
        topk.top_k(df, F.col("vec_id") % 50 == 0)


def test_tree_leaves_boxes_out():
    rng = np.random.default_rng(4)
    points = (rng.normal(0, 20, (20, 8))[rng.integers(0, 20, 8000)] + rng.normal(0, 1, (8000, 8))).astype(np.int64)
    tree = topk.KDTree(points, np.arange(8000))
    q = points[:1].astype(np.float64)
    found, scored = tree.search(q[0], tree.bounds(q)[0], 0, 5, (topk.LEAST, topk.LEAST))
    want = sorted(((int(points[c] @ points[0]), -c) for c in range(1, 8000)), reverse=True)[:5]
    assert sorted(found, reverse=True) == want and scored < len(tree.span) / 2


# ---------------------------------------------------------------- language, quality, licences


def test_language_of_edge_cases(spark, docs, empty):
    rng = random.Random(2)
    make = {"xx": "ka mo tsu ri", "yy": "sch ein heit und", "zz": "ção ões lha nho"}
    rows = [(i, "".join(rng.choice(make[x].split()) + rng.choice(["", " "]) for _ in range(80)), x) for i, x in enumerate(["xx", "yy", "zz"] * 60)]
    train = spark.createDataFrame([*rows, (900, None, "xx"), (901, "123 !", "yy"), (902, "kamo", None), (None, "mori", "xx")], "doc_id long, text string, lang string")
    model = langid.fit(train)
    assert model.langs == ["xx", "yy", "zz"]
    out = {r.doc_id: r for r in langid.predicted(train, model).collect()}
    assert sum(out[i].lang_pred == x for i, _, x in rows) == len(rows) and all(0 <= r.score <= 1 for r in out.values())
    assert out[900].lang_pred == out[901].lang_pred == "und" and out[901].score == 0 and out[901].rejected
    kept = langid.identified(docs, model)
    assert kept.dtypes == docs.dtypes and {3, 4, 5}.isdisjoint(r.doc_id for r in kept.collect())
    assert {r.score for r in docs.limit(3).collect()} == {7} and dict(langid.predicted(docs, model).dtypes)["score"] == "double"
    none = langid.fit(empty)
    assert {(r.lang_pred, r.rejected) for r in langid.predicted(docs, none).collect()} == {("und", True)}
    assert langid.identified(empty, model).count() == 0


def test_languages_left_out_of_training_are_rejected(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("lang IS NOT NULL").select("doc_id", "text", "lang")
    model = langid.fit(docs.where("lang <> 'es'"))
    share = {r.new: r.share for r in langid.predicted(docs, model).groupBy((F.col("lang") == "es").alias("new")).agg(F.avg(F.col("rejected").cast("int")).alias("share")).collect()}
    assert share[True] > 0.3 and share[False] < 0.02


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_rejection_costs_what_it_may(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").select("doc_id", "text", "lang")
    out = langid.predicted(docs, langid.fit(docs)).where("lang_pred = lang")
    n, gone = out.agg(F.count("*"), F.sum(F.col("rejected").cast("int"))).first()
    assert n > 150 and gone <= 0.002 * n


def test_every_labelled_text_is_learned_from_and_calibrates(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(i, say(rng, 30) if i % 2 else say(rng, 30).translate(str.maketrans("Abcde", "vwxyz")), "xy"[i % 2]) for i in range(400)]
    fitted = lambda rows: langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows_per_lang=10)
    found, histograms = [], langid._histograms
    monkeypatch.setattr(langid, "_histograms", lambda *a: found.append(histograms(*a)) or found[-1])
    model = fitted(rows)
    assert found[0][1].sum() > 350  # all but those of the start, however many there are
    assert np.array_equal(model.scores, fitted(rows).scores)
    for i in (7, 100, 251):  # most rows are not in the start
        other = fitted([(n, "quite other words here" if n == i else t, x) for n, t, x in rows])
        assert not np.array_equal(model.scores, other.scores)


def test_no_sample_gives_languages_start_or_thresholds(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(i, say(rng, 30) if i % 2 else say(rng, 30).translate(str.maketrans("Abcde", "vwxyz")), "xy"[i % 2]) for i in range(400)]
    rows += [(1000 + k, "".join(chr(0x4E00 + 50 * k + rng.randrange(40)) for _ in range(60)), f"z{k:02}") for k in range(40)]  # one text each
    docs = spark.createDataFrame(sorted(rows, key=lambda r: r[2]), "doc_id long, text string, lang string").repartitionByRange(5, "lang")
    found, histograms = [], langid._histograms
    monkeypatch.setattr(langid, "_histograms", lambda *a: found.append(histograms(*a)) or found[-1])
    model = langid.fit(docs)
    assert model.langs == sorted({r[2] for r in rows})
    assert found[0][1].sum() == 400  # all that the other fold can know
    assert all(r.lang_pred == r.lang for r in langid.predicted(docs, model).collect())
    learned, langs = langid._labelled(docs, "doc_id", "text", "lang", 512)
    shares = langid._shares(learned, {x: i for i, x in enumerate(langs)}).sum(0)
    for lang in ("x", "y", "z07"):
        want = np.zeros(langid.BUCKETS)
        for text in (r[1].encode() for r in rows if r[2] == lang):
            bucket, count = langid._counts(np.frombuffer(text, np.uint8))
            want[bucket] += count / (3 * len(text))
        assert np.allclose(shares[langs.index(lang)], want, rtol=1e-5)


def test_threshold_has_the_confidence_it_states():
    scores = np.zeros(100, np.int64)
    scores[[10, 20, 30, 40, 99]] = [1, 1, 1, 1, 2990]
    assert langid._threshold(scores, 0.001) == 0.0  # under 2,995 rows one can't tell
    scores[99] = 2995
    assert langid._threshold(scores, 0.001) == 0.10  # none may lie lower: chance of 0 in 2,999 is 0.0497
    scores[99] = 8400
    assert langid._threshold(scores, 0.001) == 0.40  # at most 3 of 8,404: chance 0.03; 4: 0.08
    assert langid._threshold(np.zeros(100, np.int64), 0.001) == 0.0


def test_blocks_of_bytes_do_not_change_scores(monkeypatch):
    import pyarrow as pa

    from ecoflux.llm.common import utf8

    rng = np.random.default_rng(1)
    model = langid.Model(["a", "b"], rng.normal(size=(langid.BUCKETS, 2)).astype(np.float32), np.zeros(2))
    texts = pa.array(["", "a", "ab", None, "Éa b", "long text " * 50, "zz"])
    whole = model.logits(*utf8(texts))
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert np.allclose(whole, model.logits(*utf8(texts)), atol=1e-6)
    assert np.allclose(whole[4], model.logits(*utf8(texts.slice(4, 1)))[0], atol=1e-6)


def test_tallies_equal_a_plain_count(monkeypatch):
    import pyarrow as pa

    from ecoflux.llm.common import utf8

    rng = random.Random(13)
    texts = ["", None, "a", "Éa b", "A-b\n", "zz" * 40, *("".join(rng.choice("ab cÉ\t9é") for _ in range(rng.randrange(40))) for _ in range(30)), ""]
    want = {}
    for i, text in enumerate(texts):
        plain = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in (text or "").encode()).lower()
        for n in langid.GRAMS:
            for gram in (plain[at : at + n] for at in range(len(plain) - n + 1)):
                if gram.strip(b" "):
                    bucket = ((int.from_bytes(gram, "little") * 2654435761 + (n - 1) * 0x3C6EF372) % (1 << 32)) >> (32 - langid.BUCKETS.bit_length() + 1)
                    want[i, bucket] = want.get((i, bucket), 0) + 1
    model = langid.Model(["a"], np.zeros((langid.BUCKETS, 1), np.float32), np.zeros(1))
    different = [sum(b % langid.VARIETY_SHARE == 0 for j, b in want if j == i) for i in range(len(texts))]
    for block, rows in ((1 << 16, 1 << 16), (50, 1 << 16), (50, 2), (7, 1)):
        monkeypatch.setattr(langid, "BLOCK", block)
        monkeypatch.setattr(langid, "ROWS", rows)
        got = [(d, b, n) for part in langid.tallies(*utf8(pa.array(texts))) for d, b, n in zip(*(x.tolist() for x in part))]
        assert got == [(*key, n) for key, n in sorted(want.items())]
        assert model.read(*utf8(pa.array(texts)))[1].tolist() == np.searchsorted(langid.VARIETY, different, "right").tolist()


def test_scoring_sorts_in_proportion_to_the_batch(monkeypatch):
    import pyarrow as pa

    from ecoflux.llm.common import utf8

    rng = random.Random(14)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200)) for _ in range(400)]
    model = langid.Model(["a"], np.zeros((langid.BUCKETS, 1), np.float32), np.zeros(1))
    monkeypatch.setattr(langid, "BLOCK", 256)
    sorted_rows, plain = [], {"sort": np.sort, "unique": np.unique}
    for name, f in plain.items():
        monkeypatch.setattr(np, name, lambda a, *more, f=f, **named: sorted_rows.append(len(a)) or f(a, *more, **named))

    def work(n: int) -> int:
        sorted_rows.clear()
        model.read(*utf8(pa.array(texts[:n])))
        return sum(sorted_rows)

    assert 0 < work(400) < 5 * work(100)  # four times the texts; they were sorted again and again: 12 times the work


def test_quality_is_learned_and_calibrated(spark, docs, empty):
    rng = random.Random(7)
    rows = [(i, say(rng, 60) if i % 3 else "JUNK!! " * rng.randrange(20, 60)) for i in range(400)] + [(900, None), (901, ""), (None, "x y")]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 400, 2)] + [(0, 0), (1, None), (None, 1), (77777, 1)], "id long, y int")
    out = {r.id: r.score for r in quality.quality(frame(spark, rows), labels).collect()}
    assert len(out) == len(rows) and all(0 <= s <= 1 for s in out.values())
    assert all((out[i] >= 0.7) == (i % 3 > 0) for i in range(1, 400, 2))  # never seen
    assert {r.score for r in quality.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality(empty, labels).count() == 0


def test_pooling_is_isotonic():
    x, y, n = np.arange(6.0), np.array([0, 0.5, 0.2, 0.2, 1, 0.9]), np.array([1, 1, 1, 2, 1, 1.0])
    at, value = quality.pooled(x, y, n)
    assert (np.diff(value) > 0).all() and value[0] == 0 and value[1] == pytest.approx(1.1 / 4) and value[2] == pytest.approx(0.95)


def test_licences_and_their_differences(spark, empty):
    mit, apache = license_scan.TEMPLATES["MIT/text"], license_scan.TEMPLATES["Apache-2.0/short"]
    rng = random.Random(9)
    rows = [
        (1, f"{say(rng, 300)}\n{mit}\n{say(rng, 300)}"),
        (2, say(rng, 40) + " " + mit.replace("free of charge, ", "").replace(" ", "\n  ") + " " + apache),
        (3, None), (4, ""), (5, "the license"), (6, say(rng, 2000)), (7, "# " + apache.upper()), (7, apache + " " + apache),
    ]
    got = sorted((r.id, r.at, r.template, r.exact, tuple(r.missing), tuple(r.extra)) for r in license_scan.scan(frame(spark, rows)).collect())
    short = "Apache-2.0/short"
    assert [g[:1] + g[2:] for g in got] == [
        (1, "MIT/text", True, (), ()), (2, "MIT/text", False, ("free", "of", "charge"), ()), (2, short, True, (), ()),
        (7, short, True, (), ()), (7, short, True, (), ()), (7, short, True, (), ()),
    ]
    assert got[0][1] == 300 and license_scan.scan(empty).count() == 0


def test_many_licences_in_one_text(spark):
    import time

    names = ["MIT/text", "Apache-2.0/short", "GPL-3.0/header", "MIT/short"]
    text = " ".join(license_scan.TEMPLATES[n] for n in names * 300)
    began = time.time()
    got = license_scan.scan(frame(spark, [(1, text)])).orderBy("at").collect()
    assert [r.template for r in got] == names * 300 and all(r.exact for r in got) and time.time() - began < 60


def _scanned(words, tolerance=0.15, templates=license_scan.TEMPLATES):
    scanner = license_scan.Scanner(templates, 12, 2, 3, tolerance, 3)
    return sorted((at, n, name, tuple(missing), tuple(extra)) for at, n, name, _, missing, extra, _, _ in scanner.findings(words))


def _own(name):
    return license_scan.Scanner(license_scan.TEMPLATES, 12, 2, 3, 0.15, 3).words[name]


@pytest.mark.parametrize("name", ["Apache-2.0/header", "MIT/text", "GPL-3.0/header"])
def test_adjoining_near_copies_are_judged_one_by_one(name):
    own = _own(name)
    n, changed = len(own), lambda i: own[:i] + [b"zzz"] + own[i + 1 :]
    one = lambda at, i: (at, n, name, (own[i],), (b"zzz",))
    assert _scanned(changed(n // 2)) == [one(0, n // 2)]
    for apart in (0, 5, 12):
        between = [b"q%d" % i for i in range(apart)]
        assert _scanned(changed(n // 2) + between + changed(n // 4)) == [one(0, n // 2), one(n + apart, n // 4)]
        cut = own[: n // 3] + own[n // 3 + 2 :]
        want = [(0, n - 2, name, tuple(own[n // 3 : n // 3 + 2]), ()), one(n - 2 + apart, n // 2), (2 * n - 2 + 2 * apart, n, name, (), ())]
        assert _scanned(cut + between + changed(n // 2) + between + own) == want


def test_short_notices_beside_parts_of_long_ones_are_found():
    mit, apache = _own("MIT/text"), _own("Apache-2.0/header")
    assert _scanned(_own("MIT/short") + mit[14:65]) == [(0, 5, "MIT/short", (), ())]
    for part in (apache[19:70], apache[-40:]):
        assert _scanned(_own("All-rights-reserved/short") + part) == [(0, 3, "All-rights-reserved/short", (), ())]
        assert _scanned(part + _own("All-rights-reserved/short")) == [(len(part), 3, "All-rights-reserved/short", (), ())]


def test_more_templates_hide_no_notice():
    rng = random.Random(3)
    long = {f"long{i}": license_scan.TEMPLATES["MIT/text"] + " " + say(rng, 20 + i) for i in range(20)}
    words = _own("MIT/short") + _own("MIT/text")[14:65]
    assert _scanned(words, templates=license_scan.TEMPLATES | long) == [(0, 5, "MIT/short", (), ())]


@pytest.mark.parametrize("name", sorted(license_scan.TEMPLATES))
def test_edits_up_to_the_tolerance_are_found_wherever_they_are(name):
    own, rng = _own(name), random.Random(5)
    n, most, new = len(own), int(0.15 * len(own) + 1e-9), [b"q%d" % i for i in range(20)]
    only = {name: license_scan.TEMPLATES[name]}  # CC BY-NC without NC is CC BY
    found = lambda words: [len(r[3]) + len(r[4]) for r in _scanned(new[:3] + words + new[:3], templates=only)]
    assert found(own) == [0]
    for at in range(1, n):  # all in one place; words before or after it can count as missing instead
        assert found(own[:at] + new[:most] + own[at:]) == [min(most, at, n - at)]
    for first in (2, max(2, n // 2 - most)):  # one after every two words
        words = own[:first]
        for i in range(first, n, 2):
            words = words + ([new[(i - first) // 2]] if (i - first) // 2 < most else []) + own[i : i + 2]
        assert found(words) == [most]
    for _ in range(30):  # anywhere, of any kind
        words, left = [(w, True) for w in own], rng.randint(0, most)
        for k in range(left):
            i = rng.randrange(1, len(words))
            if rng.random() < 0.5:
                words.insert(i, (new[k], False))
            elif words[i][1]:
                del words[i]
        words = [w for w, _ in words]
        (differences,) = found(words)
        assert differences <= left


def test_substitutions_three_apart_are_found():
    own = _own("Apache-2.0/header")
    words = [b"q%d" % i if i in (40, 43, 46, 49) else w for i, w in enumerate(own)]
    assert [(r[2], len(r[3]), len(r[4])) for r in _scanned(words)] == [("Apache-2.0/header", 4, 4)]


# ---------------------------------------------------------------- suffix-array dedup


def byte_cuts(df, **how):
    out = suffix_dedup.without_repeats(df, **how).collect()
    return sorted(((r.id, r.n_bytes, r.n_removed, [tuple(x) for x in r.spans], bytes(r.kept)) for r in out), key=str)


def repetitive_rows():
    rng = random.Random(21)
    passage, phrase = "Ä passage of words that many documents share, " * 2, "a phrase of forty bytes among new words."
    rows = [(i, f"{say(rng, 9)} {phrase} {say(rng, 9)}") for i in range(60)] + [(100 + i, say(rng, 6) + passage[: 60 + i] + say(rng, 6)) for i in range(30)]
    near = say(rng, 120)
    rows += [(200 + i, near[: 40 * i] + "X" + near[40 * i :]) for i in range(8)] + [(300, "ab" * 400), (301, "ab" * 100), (302, "xx" + "ab" * 99), (303, "a" * 49), (304, "a" * 50)]
    rows += [(7, near)] * 5 + [(None, near + "!")] * 6 + [(None, None), (None, ""), (-5, near), (7, near + near), (400, "日本" * 60), (401, "本日" * 60), (402, "x\x00\x01" * 40), (403, "\x01x\x00" * 40)]
    return rows + [(500, say(rng, 20_000, 50))]


@pytest.mark.parametrize("how", [{}, {"hot_docs": 2}, {"chunk_bytes": 300, "bucket_bytes": 1 << 10}, {"length": 24, "hot_docs": 5}])
def test_byte_cuts_equal_brute_force(spark, how):
    rows = repetitive_rows()
    want = brute.cut_bytes(rows, how.get("length", 50))
    assert byte_cuts(frame(spark, rows).repartition(3), **how) == want and sum(w[2] for w in want) > 5000


def test_byte_cuts_of_the_edge_cases(spark, docs, empty):
    assert byte_cuts(docs) == brute.cut_bytes(corpus()) and byte_cuts(empty) == []


def test_stretches_may_be_cut_anywhere(spark, monkeypatch):
    # (workers have their own copy of the module: the blocks of bytes are tested here)
    raw = np.frombuffer(b"".join((t or "").encode() for _, t in corpus()[:24]), np.uint8)
    off = np.concatenate(([0], np.cumsum([len((t or "").encode()) for _, t in corpus()[:24]])))

    def strings():
        return sorted((d, p, int(h)) for doc, at, n, key in suffix_dedup.stretches(raw, off, 50) for d, a, m, h in zip(doc.tolist(), at.tolist(), n.tolist(), key) for p in range(a, a + m))

    whole = strings()
    assert len(whole) == sum(max(0, n - 49) for n in np.diff(off).tolist())
    monkeypatch.setattr(suffix_dedup, "BLOCK", 61)
    monkeypatch.setattr(suffix_dedup, "MOST_STRINGS", 3)
    assert strings() == whole


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.binary(min_size=1, max_size=40), st.text("ab", min_size=1, max_size=120).map(str.encode)), min_size=1, max_size=12, unique=True), st.integers(1, 30))
def test_run_length_index_equals_sorted_suffixes(texts, length):
    index = suffix_dedup.RunIndex(texts, length)
    whole, start = b"".join(texts), [0, *index.ends.tolist()]
    suffixes = {start[n] + p: t[p:] for n, t in enumerate(texts) for p in range(len(t) - length + 1)}
    order = index.order.tolist()
    assert sorted(order) == sorted(suffixes) and [suffixes[p][:length] for p in order] == sorted(s[:length] for s in suffixes.values())
    previous = lambda p: -1 if p in start else whole[p - 1]
    above = dict(zip(order, [None, *order]))
    runs = [i for i, p in enumerate(order) if i == 0 or previous(p) < 0 or previous(p) != previous(order[i - 1]) or above.get(p - 1) != order[i - 1] - 1]
    assert index.starts.tolist() == runs and index.sample.tolist() == [order[i] for i in runs]
    common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    got = index.statistics().tolist()
    assert all(got[p] == (common(suffixes[p], suffixes[above[p]]) if above[p] is not None else 0) for p in order)
    owner = np.arange(len(texts))[::-1].copy()
    least = index.least(owner)
    for n, t in enumerate(texts):
        for p in range(len(t) - length + 1):
            assert least[start[n] + p] == min(int(o) for o, x in zip(owner, texts) if t[p : p + length] in x)


def test_a_run_length_index_of_copies_is_small():
    rng = random.Random(1)
    text = say(rng, 2000).encode()
    copies = [text[: 5 * i] + b"#" + text[5 * i :] for i in range(1, 40)]
    one, many = (suffix_dedup.RunIndex(x, 50) for x in (copies[:1], copies))
    assert len(many.order) > 38 * len(one.order) and len(many.starts) < 3 * len(one.starts)


# ---------------------------------------------------------------- source divergence


def audit_frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x", 3, [4]) for r in rows], "lang string, source string, text string, v int, df int, grp string, value int, counts array<int>")


def audit_rows():
    rng = random.Random(11)
    words = [f"{a}{b}" for a in ("Ab", "ÉÜ", "ab", "日本", "zz") for b in "abcdefghij"]
    text = lambda: rng.choice(" ,.1\n\x00[`{~").join(rng.choice(words) for _ in range(rng.randrange(30)))
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "é", None, ""]), text()) for _ in range(200)]
    rows += [("en", "s1", None), ("en", "no words", " 12 "), ("xx", "a", "one two"), ("xx", "b", None), ("xx", "c", "one"), ("alone", "a", "Same same SAME")]
    return rows + [("alone", "a", "same")] * 3 + [("de", "s1", "Ab " * 50_000 + "deb")]


def audited(df, **how):
    return sorted(tuple(r) for r in divergence.audit(df, **how).select("grp", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("how", [{}, {"spill_entries": 5}, {"spill_bytes": 300, "top": 3}])
def test_divergences_equal_brute_force(spark, how):
    rows = audit_rows()
    got = audited(audit_frame(spark, rows).repartition(4), **how)
    want = brute.audit(rows, top=how.get("top", 200))
    assert got == want and sum(x[4] for x in want) > 0


def test_divergences_of_many_sources_and_blocks(spark, monkeypatch):
    rng = random.Random(2)
    rows = [("en", f"s{i % 40}", " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 2 for _ in range(12))) for i in range(400)]
    for name, value in (("CELLS", 100), ("PAIR_CELLS", 1000), ("HELD", 10), ("CHUNK", 64), ("PART", 5)):
        monkeypatch.setattr(divergence, name, value)
    assert audited(audit_frame(spark, rows)) == brute.audit(rows)
    assert audited(audit_frame(spark, [])) == [] and audited(audit_frame(spark, [(None, None, None)])) == []


@given(st.integers(1, 9 * 10**17), st.data())
def test_shares_are_exact(total, data):
    count = data.draw(st.integers(1, total))
    assert divergence.shares(np.array([count]), np.array([total]))[0] == 1 + 10**9 * count // total


# ---------------------------------------------------------------- Merkle manifest


def proofs(out):
    text = merkle.proof_texts(F.col("path"))
    rows = out.select("id", *[merkle.as_hex(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")], text.alias("proof"), merkle.as_hex(merkle.folded(F.col("leaf"), F.col("path"))).alias("folded"))
    got = [(r.id, r.leaf, r.subroot, r.root, "".join(r.proof), r.folded) for r in rows.collect()]
    return sorted(got, key=str)


def proofs_by_hand(rows):
    return sorted(((i, leaf, sub, root, "".join(a + b for a, b in path), root) for i, leaf, sub, root, path in brute.manifest(rows)), key=str)


def manifest_frame(spark, rows):
    clash = "rank int, n int, grp string, page int, digest string, path string, levels int, leaf int, root int"
    return spark.createDataFrame([(*r, 1, 2, "g", 3, "d", "p", 4, 5, 6) for r in rows], f"doc_id long, source string, lang string, n_chars long, text string, {clash}")


def manifest_rows():
    rng = random.Random(9)
    rows = [(i, rng.choice(["s", "", None]), rng.choice(["en", "en", "de", "", None]), rng.choice([i, None]), rng.choice([None, "", "é", say(rng, 4)])) for i in range(300)]
    rows += [(7, "s", "en", 1, "x")] * 70 + [(None, None, None, None, None)] * 140 + [(None, "s", "en", 2, "y"), (-5, "s", "one leaf", 2, "y" * 100_000)]
    rows += [(i, "s", f"Ä{i % 90}", 1, "t") for i in range(400, 600)]
    return rows


def test_proofs_equal_brute_force(spark):
    rows = manifest_rows()
    assert proofs(merkle.manifest(manifest_frame(spark, rows).repartition(5))) == proofs_by_hand(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(i, "s", "en", i, "t") for i in range(65)], [(i, "s", str(i), i, "t") for i in range(65)]])
def test_small_manifests(spark, rows):
    assert proofs(merkle.manifest(manifest_frame(spark, rows))) == proofs_by_hand(rows)


def test_requests_follow_their_branches_only(spark):
    leaves = spark.range(5000).select(F.lit("g").alias("grp"), F.col("id").alias("rank"), F.lit(5000).cast("long").alias("n"), merkle.digest_of(F.col("id").cast("string")).alias("digest"))
    forest = merkle.build(leaves)
    asked = leaves.where("rank IN (0, 63, 64, 4999)").withColumn("name", F.lit("kept")).crossJoin(spark.range(2).withColumnRenamed("id", "twice"))
    out = merkle.descend(forest, asked)
    root = bytes(forest.roots.first()["digest"])
    rows = out.select("rank", "name", "twice", merkle.folded(F.col("digest"), F.col("path")).alias("root"), F.size("path").alias("n")).collect()
    assert len(rows) == 8 and {bytes(r.root) for r in rows} == {root} and {r.n for r in rows} == {13}
    changed = out.select(merkle.folded(merkle.digest_of(F.lit("other")), F.col("path")).alias("root"))
    assert root not in {bytes(r.root) for r in changed.collect()}


def test_equal_subtrees_are_one_record(spark):
    same = spark.range(64 * 40).select(F.lit("g").alias("grp"), F.col("id").alias("rank"), F.lit(64 * 40).cast("long").alias("n"), merkle.digest_of(F.lit("same")).alias("digest"))
    assert [r.count() for r in merkle.build(same).records] == [1, 1]


@pytest.mark.parametrize("module", [line_dedup, decontaminate])
def test_native_operators_have_no_python_in_tasks(module):
    import inspect
    import re

    assert not re.search(r"mapIn|applyIn|udf|pandas|pyarrow|\.rdd|numpy", inspect.getsource(module))


def test_whole_texts_are_not_shuffled(docs):
    plans = [langid.predicted(docs, langid.Model([], np.zeros((0, 0)), np.zeros(0))), license_scan.scan(docs), quality.with_statistics(docs), simhash.fingerprints(docs)]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        above = plan.split("InMemoryTableScan")[0]  # the cached test table has an exchange of its own
        assert "MapInArrow" in above and "Exchange" not in above


@pytest.mark.parametrize("size", [1, 3, 40])
def test_pieces_of_a_text_change_nothing(monkeypatch, size):
    from ecoflux.llm import common

    texts = [(t or "").encode() for _, t in corpus()]
    cache = substring_dedup._WordHashes()
    whole = [(simhash.fingerprint(t, 3), t.split(), substring_dedup._hashed(t, cache).tolist()) for t in texts if len(t) < 5000]
    monkeypatch.setattr(common, "PIECE_BYTES", size)
    again = [(simhash.fingerprint(t, 3), [w for p in common.word_pieces(t) for w in p], substring_dedup._hashed(t, cache).tolist()) for t in texts if len(t) < 5000]
    assert whole == again
