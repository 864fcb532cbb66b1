"""Edges of the training-data operators: ids that are missing or repeat, clashing columns, ties, empty tables, and whole operators against brute force."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spillway.llm import ann, chat, common, huffman, licences, line_dedup, mixing, near_dup, packing, quality, tokens, toxicity
from spillway.llm.tokens import PieceEncoder, tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Rows whose ids are missing or stand for several texts, with empty and null texts.
VAGUE = [(None, "one two three", "en", "a", 1), (None, "four five", "en", "a", 1), (None, "four five", None, None, None), (None, None, "en", "a", 1), (7, "six seven eight", "en", "b", 1), (7, "nine", "en", "b", 1), (7, "nine", "en", "b", 1), (8, "", None, "b", 0)]


@pytest.fixture(scope="module")
def vague(spark):
    return spark.createDataFrame(VAGUE, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_piece_encoder_on_extended_latin():
    rng = random.Random(1)
    letters = [chr(c) for c in range(0xA0, 0x250)] + list("abz'st <|>0́") + ["<|endoftext|>", "<|STARTOFTEXT|>", "'ll", "K", "ẞ", "Å"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        enc = PieceEncoder(tokenizer_path(name), cache_pieces=2000)
        for _ in range(6000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 12)))
            assert enc.encode(text) == enc.whole(text), text


def test_packing_with_vague_ids_and_many_cells(spark, vague):
    path = tokenizer_path("word_bpe_49k.json")
    enc = PieceEncoder(path)
    for cell_rows in (1, 1000):
        rows = packing.pack(vague, path, capacity=3, cell_rows=cell_rows).collect()
        want = collections.Counter()
        for i, text, *_ in VAGUE:
            ids = enc.whole(text or "") + bytes(4)
            want.update((i, p, min(3, len(ids) // 4 - 3 * p), zlib.crc32(ids[12 * p : 12 * p + 12])) for p in range(-(-len(ids) // 12)))
        assert collections.Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows) == want
        by = collections.defaultdict(list)
        for r in rows:
            by[r.sequence_id].append((r.offset, r.length))
        for parts in by.values():
            assert all(a[0] + a[1] == b[0] for a, b in zip(sorted(parts), sorted(parts)[1:])) and sum(n for _, n in parts) <= 3


def test_packing_needs_no_more_sequences_than_best_fit():
    rng = np.random.default_rng(5)
    for t in range(60):
        cap, n = int(rng.choice([64, 256, 2048])), int(rng.integers(1, 2000))
        sizes = (rng.lognormal(math.log(cap) * rng.uniform(0.4, 0.95), 1, n), rng.integers(1, cap + 1, n), rng.geometric(8 / cap, n))[t % 3]
        counts = np.bincount(np.clip(sizes.astype(int), 1, cap), minlength=cap + 1)
        plan, used = packing.plan(counts, cap), np.zeros(cap + 1, int)
        for pattern, m in plan:
            assert sum(pattern) <= cap
            np.add.at(used, list(pattern), m)
        assert (used == counts).all() and sum(m for _, m in plan) <= sum(m for _, m in packing._best_fit(counts.copy(), cap))


def test_sum_index_follows_the_counts():
    rng = np.random.default_rng(6)
    avail = rng.integers(0, 2, 41)
    avail[0] = 0
    index = packing.SumIndex(avail, 40)
    for x in rng.permutation(np.flatnonzero(avail)):
        index.take((int(x),), 1)
        fresh = packing.SumIndex(avail, 40)
        assert (index.single == fresh.single).all() and (index.pair == fresh.pair).all() and (index.triple == fresh.triple).all()


def test_chat_control_strings_across_turns(spark):
    rng = random.Random(2)
    parts = ["[INST", "]", "[/INST]", "<", "</s>", "s>", "\\", "<<SYS>>", "[ROLE]", "x\n"]
    rows = [(c, t, rng.choice(["system", "user", "assistant", "tool", "", "[/ROLE]"]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))) for c in [*range(40), None] for t in range(4)]
    segments = chat.format_segments(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    whole = collections.defaultdict(list)
    for r in segments.collect():
        whole[r.conv_id].append((r.segment, r.text))
    fmt = chat.Format(chat.INSTRUCT)
    for c, found in whole.items():
        text = "".join(x for _, x in sorted(found))
        assert [(r, x) for r, x, _ in fmt.parse(text)] == [(r, x) for i, _, r, x in sorted((r for r in rows if r[0] == c), key=lambda r: r[1]) if i == c]
    told = {r.conv_id: tuple(r) for r in chat.digest(segments).collect()}
    assert told == {r.conv_id: tuple(r) for r in chat.digest(segments, in_order=True).collect()} and len(told) == 41


def test_mixing_carries_clashing_columns_and_vague_ids(spark, vague, empty):
    clash = vague.withColumns({"mx_size": F.lit(77), "MX_source": F.lit("mine"), "mx_copy": F.lit(5)})
    out = mixing.mix(clash)
    assert out.columns == clash.columns and {(r.mx_size, r.MX_source, r.mx_copy) for r in out.collect()} <= {(77, "mine", 5)}
    assert mixing.plan(vague).count() == len(VAGUE) and mixing.mix(empty).count() == 0
    # A source of rows without ids takes about its target, not all or nothing.
    rows = [(None, f"w{i} a b c", "en", f"s{i % 2}", 1) for i in range(4000)]
    planned = mixing.plan(spark.createDataFrame(rows, SCHEMA)).groupBy("source").agg(F.first("mx_target").alias("target"), F.sum(F.col("mx_size") * F.col("mx_copies")).alias("taken"), F.first("mx_source_size").alias("held")).collect()
    for r in planned:
        p = r.target / r.held % 1
        assert abs(r.taken - r.target) <= 5 * math.sqrt(p * (1 - p) * 2000 * 16)


@pytest.mark.parametrize("bytes_", [line_dedup.BROADCAST_BYTES, 0])
def test_line_dedup_edges(spark, empty, bytes_):
    rows = [(None if i % 3 else i // 6, f"Same LINE\nown {i}", "en", "s", 3) for i in range(30)] + [(1, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = line_dedup.drop_lines(docs, broadcast_bytes=bytes_).collect()
    assert sorted(r.text or "" for r in out) == sorted([f"own {i}" for i in range(30)] + [""]) and sorted(r.ld_dropped for r in out) == [0] + [1] * 30
    clash = docs.withColumns({"ld_lines": F.lit(77), "ld_h1": F.lit("mine"), "LD_drop": F.lit(1), "ld_row": F.lit("r")})
    left = line_dedup.rewritten(clash)
    assert left.columns == clash.columns
    assert {(r.ld_lines, r.ld_h1, r.LD_drop, r.ld_row) for r in left.collect()} == {(77, "mine", 1, "r")} and {r.n_chars for r in left.collect() if r.text} == {5, 6}
    assert line_dedup.rewritten(empty).count() == 0


def test_line_index_tells_keys_of_one_hash_apart():
    h1, h2 = np.array([5, 5, 5, 9], np.int64), np.array([1, 2, -3, 4], np.int64)
    row = line_dedup._build(pa.table({"shard": pa.array([0] * 4, pa.int32()), "h1": h1, "h2": h2, "n": np.array([10, 20, 30, 40])})).to_pylist()[0]
    assert line_dedup.Shard(row).count(h1, h2).tolist() == [10, 20, 30, 40] and line_dedup.Shard(row).count(np.array([5, 6]), np.array([4, 1])).tolist() == [0, 0]
    # A fold that does not tell them apart is given up for the next.
    a, b = np.array([0, 3], np.int64), np.array([3, 0], np.int64)
    assert len(set(line_dedup._folded(a, b, 0).tolist())) == 1
    row = line_dedup._build(pa.table({"shard": pa.array([0, 0], pa.int32()), "h1": a, "h2": b, "n": np.array([1, 2])})).to_pylist()[0]
    assert row["seed"] > 0 and line_dedup.Shard(row).count(a, b).tolist() == [1, 2]


def _plain_sets(rows):
    out = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or ""))
        out.append(set(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def _classes(sets):
    """The smallest row that each row is linked with, by plain comparison."""
    top = list(range(len(sets)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                top[b] = a
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize("block", [16, 256])
def test_near_duplicate_families_of_all_sizes(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK_DOCS", block)
    rng, rows = random.Random(block), []
    for family, size, edits in (("a", 120, 5), ("b", 60, 14), ("c", 3, 2), ("d", 40, 30)):
        base = [f"{family}{i}" for i in range(150)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randint(0, edits)):
                w[rng.randrange(150)] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(w), "en", "s", 0))
    want = _classes(_plain_sets(rows))
    out = {r.doc_id: r for r in near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [out[i].component_id for i in range(len(rows))] == want and [out[i].n_shingles for i in range(len(rows))] == [len(s) for s in _plain_sets(rows)]


def test_near_dedup_shuffles_no_texts_and_sketches_once(spark, monkeypatch):
    text = lambda w, n=60: " ".join(f"{w}{i}" for i in range(n))
    rows = [(i if i % 7 else None, text(f"f{i % 9}") + f" end{i % 31}") for i in range(120)] + [(500 + i, text(f"g{i}")) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    plans, real = {}, near_dup.materialize

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    told = lambda: collections.Counter(near_dup.near_duplicates(docs).collect())
    before = told()
    monkeypatch.setattr(near_dup, "materialize", seen)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where no table is small
    try:
        with common.owning("near-dedup test"):
            assert told() == before
        left = [path for path, (_, whose) in common._written.items() if whose == "near-dedup test"]
        monkeypatch.setattr(near_dup, "MOST_BITS", 64, raising=False)  # bitmaps that let everything pass
        assert told() == before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        common.release_scratch("near-dedup test")
    assert "hashpartitioning(first" not in plans["dup-links"] and plans["dup-lists"].count("hashpartitioning(v#") == 1
    assert left and not [path for path in left if path.endswith(("dup-signatures", "dup-sketches"))]


def test_near_dedup_bitmaps_pass_all_that_is_wanted(spark):
    rng = random.Random(12)
    wanted, others = (np.array([rng.randrange(-(2**63), 2**63) for _ in range(3000)]) for _ in range(2))
    bitmap = near_dup._bitmap(spark.createDataFrame([(int(h),) for h in wanted], "h long")).value
    assert near_dup._passes(bitmap, wanted).all() and near_dup._passes(bitmap, others).mean() < 0.1
    none = near_dup._bitmap(spark.createDataFrame([], "h long")).value
    assert not near_dup._passes(none, others).any()


def test_near_dedup_edges(spark, vague, empty):
    clash = vague.withColumns({"nd_own": F.lit(1), "nd_id": F.lit("mine"), "ND_n": F.lit(2)})
    left = near_dup.dedup(clash)
    assert left.columns == clash.columns and collections.Counter((r.doc_id, r.text, r.nd_id) for r in left.collect()) == collections.Counter({(None, "one two three", "mine"): 1, (None, "four five", "mine"): 1, (None, None, "mine"): 1, (7, "six seven eight", "mine"): 1, (7, "nine", "mine"): 1, (8, "", "mine"): 1})
    assert near_dup.dedup(empty).count() == 0


def test_toxicity_scores_equal_a_full_scan(spark, empty):
    rng = random.Random(8)
    word = lambda: f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.choice('aeiou')}{rng.choice('xyz')}"
    rows, labels = [], []
    for i in range(260):
        w = [word() for _ in range(rng.randint(1, 60))] + ["the"] * rng.randint(0, 3)
        if i % 5 == 0:
            w[: len(w) // 8 + 1] = [rng.choice(["nasty", "vile", "foul"])] * (len(w) // 8 + 1)
        rows.append((i, " ".join(w), "en", "s", 0))
        if i < 180:
            labels.append((i, int(i % 5 == 0)))
    rows += [(None, rows[0][1], "en", "s", 0), (3, "vile vile", "en", "s", 0), (3, "other words", "en", "s", 0), (300, None, "en", "s", 0), (301, "9 8 !", "en", "s", 0)]
    docs, training = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs.filter("doc_id IS NULL OR doc_id <> 3 OR n_chars = 0"), training)
    terms = lambda t: collections.Counter(re.findall(r"[^\W\d_]+", (t or "").lower()))
    # Vectors by hand: all terms of a text, whole-corpus frequencies.
    df = collections.Counter(t for r in rows for t in terms(r[1]))
    weight = {t: model.term_weight[i] for t, i in model.number.items()}

    def vector(text):
        v = {t: (1 + math.log(n)) * (weight[t] if t in weight else toxicity.LEAST_WEIGHT * (math.log((1 + len(rows)) / (1 + df[t])) + 1)) for t, n in terms(text).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}

    text_of = {i: next(r[1] for r in rows if r[0] == i) for i in model.ids.tolist() if i != 3}
    held = [vector(text_of.get(i, model and next(r[1] for r in rows if r[0] == i))) for i in model.ids.tolist()]
    for i, text in [(r[0], r[1]) for r in rows][:80:2] + [(None, rows[0][1]), (301, "9 8 !"), (300, None)]:
        v = vector(text)
        s = np.array([sum(x * h[t] for t, x in v.items() if t in h) for h in held])
        best = [int(j) for j in np.lexsort((np.arange(len(s)), -np.round(s, 9))) if s[j] > 0][: model.k]
        score, evidence = model.score(text)
        if 3 not in model.ids[best].tolist():  # which of the two texts of id 3 is the example is not asked here
            assert sorted(np.round(s[best], 6)) == sorted(np.round([s[model.ids.tolist().index(e)] for e in evidence], 6))
            near = [(model.weight[j] / (1.05 - min(s[j], 1)), model.labels[j]) for j in best]
            want = np.interp(sum(a * b for a, b in near) / sum(a for a, _ in near), model.votes, model.chances) if near else model.none
            assert score == pytest.approx(want, abs=1e-4)
    out = toxicity.score(docs, training).collect()
    assert collections.Counter(r.doc_id for r in out) == collections.Counter(r[0] for r in rows)
    assert toxicity.drop_toxic(empty, training).count() == 0 and toxicity.drop_toxic(docs, training.limit(0)).count() == len(rows)


@pytest.mark.parametrize("dense", [1, 32, 10**6])
def test_block_max_search_with_any_share_of_dense_rows(monkeypatch, dense):
    monkeypatch.setattr(toxicity.BlockMaxIndex, "DENSE", dense)
    rng = random.Random(dense)
    vectors = [{t: rng.random() for t in rng.sample(range(60), rng.randint(0, 9))} for _ in range(500)]
    index = toxicity.BlockMaxIndex(vectors, block=16)
    queries = [{t: rng.random() for t in rng.sample(range(70), rng.randint(0, 8))} for _ in range(70)]
    for q, (at, score) in zip(queries, index.search_many(queries, 10, [3] * 70)):
        s = np.array([sum(x * v.get(t, 0) for t, x in q.items()) for v in vectors])
        s[3] = 0
        best = [i for i in np.lexsort((np.arange(500), -np.round(s, 12))) if s[i] > 0][:10]
        assert at.tolist() == best and np.allclose(score, s[best])
    assert toxicity.BlockMaxIndex([]).search({1: 1.0}, 5)[0].tolist() == []


def test_block_max_search_answers_queries_together(monkeypatch):
    rng = random.Random(3)
    vectors = [{t: rng.random() for t in rng.sample(range(400), rng.randint(0, 30))} for _ in range(900)]
    queries = [{t: rng.random() for t in rng.sample(range(420), rng.randint(0, 40))} for _ in range(130)]
    index, calls, spans = toxicity.BlockMaxIndex(vectors, block=16), [], toxicity._spans
    monkeypatch.setattr(toxicity, "_spans", lambda lo, hi: calls.append(1) or spans(lo, hi))
    but = [rng.randrange(-1, 900) for _ in queries]
    want = index.search_many(queries, 12, but)
    assert len(calls) <= 9  # three a part of 64, however many queries
    monkeypatch.setattr(toxicity.BlockMaxIndex, "PART_POSTS", 700)
    alone = index.search_many(queries, 12, but)
    for q, x, (at, score), (at2, _) in zip(queries, but, want, alone, strict=True):
        s = np.array([sum(w * v.get(t, 0) for t, w in q.items()) for v in vectors])
        if x >= 0:
            s[x] = 0
        assert at.tolist() == at2.tolist() == [i for i in np.lexsort((np.arange(900), -np.round(s, 12))) if s[i] > 0][:12] and np.allclose(score, s[at])


def test_terms_of_every_character(monkeypatch):
    import re
    import sys

    pattern = re.compile(r"[^\W\d_]+")
    for c in range(sys.maxunicode + 1):
        text = f"A{chr(c)}b 1{chr(c)}_{chr(c)}{chr(c)}"
        if c < 0x3000 or c % 61 == 0:
            assert toxicity.terms_of(text) == pattern.findall(text.lower()), c
    monkeypatch.setattr(toxicity, "_TERM", None)
    assert toxicity.terms_of("Ein Maß, 3 Öfen\u00a0dort\x85_été") == ["ein", "maß", "öfen", "dort", "été"] and toxicity.terms_of(None) == []


@pytest.mark.parametrize("clustered", [False, True])
def test_nearest_vectors_reach_the_recall(spark, clustered):
    rng = np.random.default_rng(9)
    v = rng.normal(size=(4000, 24)) * (0.2 if clustered else 1)
    if clustered:
        v += rng.normal(size=(40, 24))[rng.integers(0, 40, 4000)]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(None, v[0].tolist()), (20, (v[20] + 100).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v[20] = min(v[20].tolist(), (v[20] + 100).tolist())
    hit, asked = 0, range(0, 4000, 20)
    got = collections.defaultdict(list)
    for r in ann.search(df, F.col("vec_id") % 20 == 0, k=20).collect():
        got[r.query_id].append(r.vec_id)
        assert r.score == pytest.approx(float(v[r.query_id] @ v[r.vec_id]), rel=1e-12)
    for q in asked:
        s = v @ v[q]
        s[q] = -np.inf
        hit += len(set(got[q]) & set(np.argsort(-s)[:20].tolist()))
        assert len(got[q]) == 20
    assert hit / (20 * len(asked)) >= 0.9


def _rows_made(spark, name: str, since: int) -> int:
    """Rows that operators of this name made in executions after one."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store, made = spark._jsparkSession.sharedState().statusStore(), 0
    for e in (store.executionsList().apply(i) for i in range(store.executionsList().size())):
        values, nodes = store.executionMetrics(e.executionId()), store.planGraph(e.executionId()).allNodes()
        for node in (nodes.apply(i) for i in range(nodes.size())) if e.executionId() > since else ():
            if node.name().startswith(name):
                metrics = [node.metrics().apply(i) for i in range(node.metrics().size())]
                made += sum(int(values.get(m.accumulatorId()).get().replace(",", "")) for m in metrics if m.name() == "number of output rows" and values.get(m.accumulatorId()).isDefined())
    return made


def test_nearest_vectors_find_few_a_query_however_many_leaves_are_read(spark):
    v = np.random.default_rng(12).normal(size=(12_000, 24))
    df = spark.createDataFrame(list(enumerate(v.tolist())), "vec_id long, embedding array<double>")
    store = spark._jsparkSession.sharedState().statusStore()
    since = max((store.executionsList().apply(i).executionId() for i in range(store.executionsList().size())), default=-1)
    assert ann.search(df, F.col("vec_id") % 20 == 0, k=20).count() == 12_000
    assert 0 < _rows_made(spark, "FlatMapCoGroupsInArrow", since) <= 600 * 20 * 4


def test_nearest_vectors_in_small_parts(spark, monkeypatch):
    """Leaves beyond a block, shards of few leaves and queries in parts find what one task would."""
    rng = np.random.default_rng(13)
    v = rng.normal(size=(3000, 8))
    v[1000:2000] = v[1000]
    df = spark.createDataFrame(list(enumerate(v.tolist())), "vec_id long, embedding array<double>")
    want = ann.search(df, F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect()
    monkeypatch.setattr(ann, "BLOCK", 300)
    monkeypatch.setattr(ann, "QUERIES", 40)
    assert ann.search(df, F.col("vec_id") % 20 == 0, k=20).orderBy("query_id", "rank").collect() == want and len(want) == 3000


def test_licences_against_a_full_scan(spark):
    rng = random.Random(10)
    templates = {f"L{i}": " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()) for _ in range(9)) for i in range(5)}
    noise = [f"n{i}" for i in range(30)]
    files = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 6)):
            w = templates[f"L{rng.randrange(5)}"].split() if rng.random() < 0.4 else [rng.choice(noise) for _ in range(rng.randint(0, 7))]
            for _ in range(rng.randint(0, 3)):
                w.insert(rng.randint(0, len(w)), rng.choice(noise))
            cut = rng.randint(0, len(w))
            lines += [" ".join(w[:cut]), " ".join(w[cut:])]
        files.append((f"d{i % 7}/{i % 3}/f{i}", "\n".join(lines)))
    files += [("long/f", "\n".join(["alpha " + " ".join(rng.choice(noise) for _ in range(5))] * 3000 + [templates["L2"]]))]
    terms = lambda t: collections.Counter(re.findall(r"[^\W_]+", t.lower()))
    vocabulary = {t for x in templates.values() for t in terms(x)}
    n, df = len(files), collections.Counter(t for _, x in files for t in set(terms(x)) & vocabulary)
    idf = lambda t: math.log((1 + n) / (1 + df[t] if t in vocabulary else 1)) + 1

    def vector(text):
        v = {t: (1 + math.log(k)) * idf(t) for t, k in terms(text).items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in v.items()} if norm else {}

    known = {k: vector(x) for k, x in templates.items()}
    want = {}
    for path, text in files:
        lines = text.split("\n")
        best = (0.0, "")
        for size in (1, *licences.WINDOWS):
            for i in range(len(lines)) if len(lines) < 1000 else range(len(lines) - 8, len(lines)):
                v = vector(" ".join(lines[i : i + size]))
                for name, w in known.items():
                    s = round(sum(x * w[t] for t, x in v.items() if t in w), 6)
                    if s >= licences.THRESHOLD and (-s, name) < (-best[0], best[1]):
                        best = (s, name)
        want[path] = best
    out = {r.path: r for r in licences.scan(spark.createDataFrame(files, "path string, text string"), templates).collect()}
    assert {p: (out[p].licence or "", pytest.approx(out[p].score or 0.0, abs=1e-5)) for p in want} == {p: (name, s) for p, (s, name) in want.items()}
    assert sum(1 for s, _ in want.values() if s) > 20 and want["long/f"][1] == "L2"


def test_token_files_with_vague_ids(spark, vague, empty):
    path = tokenizer_path("byte_bpe_50k.json")
    enc = PieceEncoder(path)
    docs = vague.union(spark.createDataFrame([(-(2**63), "least", None, None, None), (5, "long " * 3000, None, None, None)], SCHEMA))
    for file_ids, block in ((4, 3), (10**6, huffman.BLOCK)):
        out = common.scratch_path(spark, "edges")
        made = huffman.write_files(docs, path, out, file_ids=file_ids, block=block).orderBy("start").collect()
        rows = huffman.read_files(spark, out).orderBy("start").collect()
        want = collections.Counter((r.doc_id, enc.whole(r.text or "") + bytes(4)) for r in docs.collect())
        assert collections.Counter((r.doc_id, bytes(r.ids)) for r in rows) == want
        ids = [r.doc_id for r in rows]
        assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and sum(r.docs for r in made) == len(rows)
        at = 0
        for r in rows:
            assert r.start == at and r.ids_crc32 == zlib.crc32(bytes(r.ids))
            at += r.n_tokens
        assert at == sum(r.ids for r in made)


def test_table_encoder_gives_the_librarys_ids(monkeypatch):
    rng = random.Random(7)
    plain = [chr(i) for i in range(256) if not tokens._BEYOND(chr(i))]
    blanks = [*" " * 30, *"'" * 5, *"\n\t\r\xa0ssttrevmlldabAB09-.\xb2\xbd\xe9\xdf\xd7\xaa"]
    texts = ["".join(rng.choices(plain if i % 3 else blanks, k=rng.choice([0, 1, 2, 3, 8, 30, 200]))) for i in range(900)]
    texts += ["a" * 40 + " " + "b" * 17 + " " + "c" * 16, "x  ", "  x", "it's 'tis we'll''s 'RE \n 's", "\x00 \x85", "żółć œuvre", "Привет <|endoftext|> мир", "a <|endoftext|>"]
    texts += [" ".join("".join(rng.choices("aeinrst", k=rng.randint(2, 9))) for _ in range(400)) for _ in range(5)]
    rng.shuffle(texts)
    for name, end in (("byte_bpe_50k.json", 0), ("word_bpe_49k.json", 7)):
        whole = PieceEncoder(tokenizer_path(name)).whole
        want = [[*np.frombuffer(whole(t), "<u4").tolist(), end] for t in texts]
        for most, stretch, size in ((10**6, 10**6, 1000), (300, 60, 9)):  # the second empties its table and cuts long texts, again and again
            monkeypatch.setattr(tokens, "_STRETCH", stretch)
            enc, got = tokens.TableEncoder(tokenizer_path(name), end, most), []
            for lo in range(0, len(texts), size):
                ids, ends = enc.encode(texts[lo : lo + size])
                got += [x.tolist() for x in np.split(ids, ends)[:-1]]
            assert got == want
    # New pieces go to the library together, known ones not at all.
    enc, asked = tokens.TableEncoder(tokenizer_path("byte_bpe_50k.json"), 0), []
    ask = enc._ask
    monkeypatch.setattr(enc, "_ask", lambda given: asked.append(len(given)) or ask(given))
    for _ in range(2):
        enc.encode([" some words and others", " words and more"])
    assert asked == [1]


def test_quality_of_vague_rows(spark, vague):
    trusted = spark.createDataFrame([(None,), (7,)], "doc_id long")
    assert quality.judge(vague.withColumn("q_score", F.lit("mine")), trusted).count() == len(VAGUE)


def test_scratch_tables_have_owners(spark):
    with common.owning("a"):
        mine = common.materialize(spark.range(3), "mine")
    free = common.materialize(spark.range(4), "free")
    common.release_scratch("b")
    assert mine.count() == 3
    common.release_scratch("a")
    assert free.count() == 4
    with pytest.raises(Exception, match="mine"):
        mine.count()


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    import corpus_pipeline as pipeline

    rng = random.Random(12)
    word = lambda: f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.choice('aeiou')}"
    rows, labels = [], []
    for i in range(240):
        w = [word() for _ in range(40)]
        if i % 6 == 0:
            w[:4] = ["nasty", "vile", "foul", "vile"]
        text = " ".join(w) + ("\nShared footer" if i % 10 == 0 or i % 7 == 0 else "")
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        labels.append((i, 1, int(i % 6 == 0)))
    for i in range(240, 270):  # copies and near copies
        text = rows[i - 200][1].split("\n")[0] + (" more" if i % 2 else "")
        rows.append((i, text, "en", "s1", len(text)))
    rows += [(None, rows[1][1] + " end", "en", "s2", 3), (None, "a text of its own without an id", None, None, 3), (11, "a second text under one id", "en", "s3", 3)]
    folder = f"file://{tmp_path}"
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    stage, docs = dict(pipeline.STAGES), spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns

    def run(name):
        nonlocal docs
        out = stage[name](spark, docs, folder)
        assert name.startswith("best") or out.columns == columns
        path = f"{folder}/{name.replace(' ', '-')}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        return [tuple(r) for r in docs.collect()]

    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    clean = run("toxicity")
    copied = {i for i in range(240, 270) if (i - 200) % 6 == 0}
    assert sorted(clean, key=key) == sorted((r for r in rows if r[0] is None or (r[0] % 6 if r[0] < 240 else r[0] not in copied)), key=key)
    found = collections.Counter(k for r in clean for k in {x.strip().lower() for x in r[1].split("\n")} if k)
    cut = run("line dedup")
    kept = lambda r: "\n".join(x for x in r[1].split("\n") if found[x.strip().lower()] < 10)
    assert sorted((r[0] or -1, r[1], r[4]) for r in cut) == sorted((r[0] or -1, kept(r), len(kept(r)) if kept(r) != r[1] else r[4]) for r in clean)
    order = sorted(cut, key=key)
    top = _classes(_plain_sets(order))
    single = run("MinHash near-dedup")
    # Of each class one row stays, of its smallest id.
    assert sorted((r[0] or -1, r[1]) for r in single) == sorted((order[i][0] or -1, order[i][1]) for i in set(top))
    sizes = collections.Counter()
    for r in single:
        sizes[r[3]] += len(r[1].split())
    copies = collections.Counter((r[0] or -1, r[1]) for r in run("mixing sources to target weights"))
    planned = {(r.doc_id or -1, r.text): r.mx_copies for r in mixing.plan(spark.createDataFrame(single, SCHEMA)).collect()}
    assert copies == collections.Counter({k: n for k, n in planned.items() if n})
    packed = run("best-fit packing")
    assert collections.Counter(r[0] or -1 for r in packed if r[1] == 0) == collections.Counter(i for (i, _), n in copies.items() for _ in range(n))


def test_pipeline_over_an_empty_table(spark, tmp_path):
    import corpus_pipeline as pipeline

    folder = f"file://{tmp_path}"
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert pipeline.run(spark, folder).count() == 0


def test_a_model_sent_scores_as_the_one_fitted():
    """Its terms travel as one buffer."""
    import pickle

    import numpy as np

    from spillway.llm import toxicity as T

    terms = ["a", "b", "straße", "é"]
    m = T.Model(terms, np.array([1.0, 2.0, 0.5, 1.5]), (np.zeros(0, np.int64), np.zeros(0)), 1.0, np.arange(4), np.array([0, 1, 0, 1]), ["a straße", "b é", "a a", "b"], (1.0, 1.0), 2)
    assert isinstance(m.__getstate__()["number"], pa.Array)
    sent = pickle.loads(pickle.dumps(m))
    assert sent.number == m.number == {t: i for i, t in enumerate(terms)}
    assert sent.scores(["a", "b é", "", None, "x"]) == m.scores(["a", "b é", "", None, "x"])
