"""The training-data operators against brute force, on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spillway.llm import ann, chat, huffman, licences, line_dedup, mixing, near_dup, packing, quality, toxicity
from spillway.llm.tokens import PieceEncoder, tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+").findall
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(5)
    syllables = ["ka", "lo", "mi", "ter", "en", "su", "por", "da", "vi", "ron"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    rows = []
    for i in range(60):
        text = "\n".join(line(rng.randint(5, 20)) for _ in range(rng.randint(1, 8)))
        if i % 4 == 0:
            text += "\n  Shared FOOTER line \t"
        rows.append([i, text, "en", f"src{i % 5}", len(text)])
    rows[7][1], rows[8][1], rows[9][1] = None, "", " \n\t\n"
    rows[10][1] = rows[11][1] = rows[3][1]
    rows[12][1] = rows[3][1].replace(".", ";", 1)
    rows[13][1] = " ".join(line(12) for _ in range(900))
    rows[14][1] = "la la la la la la\nla la la la la la"
    rows[15][1] = "Größe İstanbul naïve 'll 'S 12½ \x85 x <|endoftext|> y"
    rows[16][3] = None
    rows[17][1] = "one two three"
    return [tuple(r) for r in [*rows, rows[5], rows[5]]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    # Columns that clash with names that the operators use themselves.
    return spark.createDataFrame(rows, SCHEMA).withColumns({"q_score": F.lit("mine"), "mx_size": F.lit(1), "x": F.lit(2), "file": F.lit("f"), "ld_lines": F.lit(0)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality_against_brute_force(spark, docs, empty):
    trusted = spark.createDataFrame([(i,) for i in range(0, 30)] + [(None,)], "doc_id long")
    buckets = 64
    out = quality.judge(docs, trusted, buckets=buckets).collect()

    def h(*parts, seed=42):
        for p in parts:
            seed = xxhash.xxh64_intdigest(p, seed)
        return seed

    def signed(x):
        return x - 2**64 if x >= 2**63 else x

    def longs(*xs):
        seed = 42
        for x in xs:
            seed = xxhash.xxh64_intdigest(int(x).to_bytes(8, "little", signed=True), seed)
        return signed(seed)

    def grams(text):
        u = [signed(h(w.encode())) for w in WORD(text or "")]
        return [x % buckets for x in u] + [buckets + longs(a, b) % buckets for a, b in zip(u, u[1:])]

    raw, target = collections.Counter(), collections.Counter()
    for r in corpus():
        g = grams(r[1])
        raw.update(g)
        if r[0] < 30:
            target.update(g)
    t, s = sum(target.values()) + 2 * buckets, sum(raw.values()) + 2 * buckets
    weight = [math.log((target[b] + 1) / t) - math.log((raw[b] + 1) / s) for b in range(2 * buckets)]
    assert len(out) == 62
    for r in out:
        x = r.text or ""
        w, g = WORD(x), grams(x)
        seen, covered = collections.Counter(zip(w, w[1:], w[2:])), set()
        for i in range(len(w) - 2):
            if seen[(w[i], w[i + 1], w[i + 2])] > 1:
                covered |= {i, i + 1, i + 2}
        lines = [y for y in x.split("\n") if WORD(y)]
        assert (r.q_n_words, r.q_word_chars, r.q_n_symbols, r.q_n_dup_lines, r.q_n_repeat_words) == (len(w), sum(map(len, w)), sum(x.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        assert r.q_score == pytest.approx(sum(weight[b] for b in g) / len(g) if g else 0.0, abs=1e-9)
        assert r.q_base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert r.q_kept == (not r.q_base_failed and r.q_score >= quality.THRESHOLD)
    assert quality.judge(empty, trusted).count() == 0


def test_piece_encoder_equals_the_library():
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        enc = PieceEncoder(tokenizer_path(name), cache_pieces=50)
        for r in corpus():
            assert enc.encode(r[1] or "") == enc.whole(r[1] or "")


def test_packing_places_every_piece_once(spark, docs, empty):
    path = tokenizer_path("word_bpe_49k.json")
    enc = PieceEncoder(path)
    rows = packing.pack(docs, path, capacity=256).collect()
    expected = collections.Counter()
    for r in corpus():
        ids = enc.whole(r[1] or "") + bytes(4)
        n = len(ids) // 4
        for p in range(-(-n // 256)):
            expected[(r[0], p, p * 256, min(256, n - p * 256), zlib.crc32(ids[1024 * p : 1024 * (p + 1)]))] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    # No fewer than the lengths ask for, no more than a plain first-fit by size would take.
    bins = []
    for n in sorted((r.length for r in rows), reverse=True):
        at = next((i for i, x in enumerate(bins) if x + n <= 256), None)
        if at is None:
            bins.append(n)
        else:
            bins[at] += n
    assert -(-sum(r.length for r in rows) // 256) <= len(by) <= len(bins)
    assert packing.pack(empty, path).count() == 0


def test_packing_plan_uses_up_the_counts():
    rng = np.random.default_rng(1)
    for n in (1, 50, 5000):
        counts = np.bincount(np.minimum(128, 1 + rng.geometric(0.02, n)), minlength=129)
        back = np.zeros(129, int)
        for pattern, m in packing.plan(counts, 128):
            assert sum(pattern) <= 128 and m > 0
            for x in pattern:
                back[x] += m
        assert (back == counts).all()


def test_chat_round_trip(spark):
    own = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", own), (-7, 1, "assistant", own), (1, 0, None, None), (1, 0, "tool", "\\<s\\>[[INST]INST]"), (2, 0, "user", "a"), (2, 1, "user", "b"), (3, 1, "assistant", "Ä\n</s"), (3, 0, "user", "")]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit(1))
    got = {r.conv_id: r for r in chat.digest(chat.format_segments(conv)).collect()}
    for cid in (-7, 1, 2, 3):
        turns = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == cid))
        said = [x for _, r, x in turns if r == "assistant"]
        assert got[cid].n_turns == len(turns)
        assert got[cid].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[cid].loss_chars, got[cid].loss_sha256) == (len("".join(said)), hashlib.sha256("".join(said).encode()).hexdigest())
    assert got[-7].valid and got[3].valid and not got[2].valid and not got[1].valid
    fmt = chat.Format(chat.INSTRUCT)
    rng = random.Random(0)
    for _ in range(2000):
        text = "".join(rng.choice(["[INST]", "[/INST]", "<s>", "</s>", "\\", "<", "[", "INST]", "<<SYS>>", "x"]) for _ in range(rng.randint(0, 8)))
        hidden = fmt.escape(text)
        assert fmt.unescape(hidden) == text and not any(c in hidden for c in chat.INSTRUCT.controls())
    assert chat.digest(chat.format_segments(conv.filter("conv_id = 99"))).count() == 0


def test_mixing(spark, docs, empty):
    planned = mixing.plan(docs).select("doc_id", "source", "mx_size", "mx_source_size", "mx_target", "mx_copies").collect()
    sizes = collections.Counter()
    for r in corpus():
        sizes[r[3]] += len(WORD(r[1] or ""))
    names = sorted(k for k in sizes if k is not None) + [None]
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(names)}
    target, capped, total = {}, set(), sum(sizes.values())
    while True:  # reshare until no source is above its cap
        rest, w = total - sum(3 * sizes[k] for k in capped), sum(weight[k] for k in names if k not in capped)
        target = {k: 3.0 * sizes[k] if k in capped else rest * weight[k] / w for k in names}
        over = {k for k in names if k not in capped and target[k] > 3 * sizes[k]}
        if not over:
            break
        capped |= over
    assert len(planned) == 62
    for r in planned:
        assert r.mx_target == pytest.approx(target[r.source]) and r.mx_source_size == sizes[r.source] and r.mx_copies <= 3
        rate = target[r.source] / sizes[r.source]
        assert math.floor(rate) <= r.mx_copies <= math.floor(rate) + 1
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.mx_copies for r in planned)
    assert mixing.mix(empty).count() == 0


def test_nearest_vectors(spark):
    rng = np.random.default_rng(2)
    v = rng.normal(size=(3000, 16))
    v[100:400] = v[100]  # ties
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(9000, None), (9001, [0.0] * 16), (9002, [1.0] * 15 + [None]), (9003, [float("nan")] * 16), (9004, [1.0]), (5, v[5].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("leaf", F.lit("mine"))
    got = collections.defaultdict(list)
    for r in ann.search(df, F.col("vec_id") % 50 == 0, k=10).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    hit = 0
    for q in range(0, 3000, 50):
        s = (v * v[q]).sum(1)
        best = [i for i in np.lexsort((np.arange(3000), -s)) if i != q][:10]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 11)) and [m[1] for m in mine] == sorted((m[1] for m in mine), key=lambda i: (-s[i], i))
        assert all(abs(m[2] - s[m[1]]) < 1e-9 for m in mine)
        hit += len({m[1] for m in mine} & set(best))
    assert hit / 600 >= 0.9 and set(got) == set(range(0, 3000, 50))
    few = ann.search(df.filter("vec_id < 4"), F.col("vec_id") == 0, k=10).collect()
    assert len(few) == 3 and ann.search(df.limit(0), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("bytes_", [line_dedup.BROADCAST_BYTES, 0])
def test_line_dedup(spark, docs, empty, bytes_):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    found = collections.Counter(k for r in corpus() for k in {key(x) for x in (r[1] or "").split("\n")} if k)
    expected = collections.Counter()
    for r in corpus():
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if not key(x) or found[key(x)] < 10]
        expected[(r[0], "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
    out = line_dedup.drop_lines(docs, broadcast_bytes=bytes_).collect()
    assert collections.Counter((r.doc_id, r.text or "", r.ld_lines, r.ld_dropped) for r in out) == expected and sum(r.ld_dropped for r in out) >= 10
    assert line_dedup.rewritten(docs).columns == docs.columns and line_dedup.drop_lines(empty, broadcast_bytes=bytes_).count() == 0


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**63, 20_000).astype(np.uint64))
    made = line_dedup.PerfectHash.build(keys)
    assert sorted(made.slots(keys)) == list(range(len(keys)))


def test_near_duplicates_against_brute_force(spark, docs, empty):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(160)]
    rows, fresh = list(corpus()), 0
    for i in range(300):  # a large family, at all similarities to its origin and each other
        w = list(base)
        for _ in range(rng.randint(0, 14)):
            fresh += 1
            w[rng.randrange(160)] = f"n{fresh % 97}"
        rows.append((1000 + i, " ".join(w), "en", "s", 0))
    sets = {i: set(near_dup.shingles(t).tolist()) for i, t, *_ in rows}
    parent = {i: i for i in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    out = near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA).withColumn("x", F.lit("mine"))).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), find(r.doc_id) == r.doc_id)
    left = near_dup.dedup(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == sorted({r.doc_id for r in out if r.kept and r.doc_id < 1000})
    assert near_dup.near_duplicates(empty).count() == 0


def test_near_dedup_tells_rows_without_an_id_of_their_own_apart(spark):
    text = lambda w, n=40: " ".join(f"{w}{i}" for i in range(n))
    a, b, c, d, e = (text(w) for w in "abcde")
    rows = [(None, a), (None, a + " x"), (None, b), (None, b), (None, ""), (None, None), (1, c), (1, d), (2, c + " x"), (3, d + " x"), (4, e), (5, e + " x"), (5, text("f")), (6, text("g")), (6, text("g") + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = collections.defaultdict(set)
    for r in near_dup.dedup(docs).collect():
        assert (r.doc_id, r.text) not in out[r.doc_id] or not r.text
        out[r.doc_id].add((r.doc_id, r.text))
    one_a = {t for _, t in out[None]} & {a, a + " x"}
    assert len(one_a) == 1 and {t for _, t in out[None]} - one_a == {b, "", None}
    assert {t for _, t in out[1]} == {c, d} and not out[2] and not out[3]
    assert {t for _, t in out[4]} == {e} and {t for _, t in out[5]} == {text("f")} and len(out[6]) == 1


def test_near_duplicates_link_texts_not_ids(spark):
    text = lambda w, n=40: " ".join(f"{w}{i}" for i in range(n))
    a, b, c, d, e = (text(w) for w in "abcde")
    rows = [(None, a), (None, a + " x"), (None, b), (None, b), (None, ""), (None, None), (1, c), (1, d), (2, c + " x"), (3, d + " x"), (4, e), (5, e + " x"), (5, text("f")), (6, text("g")), (6, text("g") + " x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = near_dup.near_duplicates(docs).collect()
    assert len(told) == len(rows) and {r.component_id for r in told if r.doc_id in (2, 3)} == {1} and [r.component_id for r in told if r.doc_id is None] == [None] * 6


def test_block_max_search_is_exact():
    rng = random.Random(4)
    vectors = [{t: rng.random() for t in rng.sample(range(40), rng.randint(0, 6))} for _ in range(700)]
    index = toxicity.BlockMaxIndex(vectors, block=16)
    for _ in range(100):
        q = {t: rng.random() for t in rng.sample(range(40), 4)}
        s = np.array([sum(q[t] * v.get(t, 0) for t in q) for v in vectors])
        best = [i for i in np.lexsort((np.arange(700), -np.round(s, 12))) if s[i] > 0][:10]
        at, score = index.search(q, 10)
        assert at.tolist() == best and np.allclose(score, s[best])


def test_toxicity_held_out(spark, docs, empty):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(900):
        w = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.choice('aeiou')}" for _ in range(60)]
        bad = i % 6 == 0
        for _ in range(4 if bad else 0):
            w[rng.randrange(60)] = rng.choice(["nasty", "vile", "foul"])
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(bad)))
    data, lab = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    held = {i for i in range(900) if zlib.crc32(str(i).encode()) % 3 == 1}
    training = toxicity.training_rows(lab)
    assert {r.doc_id for r in training.collect()} == set(range(900)) - held
    for r in toxicity.score(data, training).collect():
        assert 0 <= r.score <= 1 and (r.doc_id not in held or (r.score >= 0.7) == (r.doc_id % 6 == 0))
    left = toxicity.drop_toxic(data, training)
    assert left.columns == data.columns and left.filter("doc_id % 6 = 0").count() == 0 and left.count() == 750
    assert {r.score for r in toxicity.score(docs, training.limit(0)).collect()} == {0.0}
    assert toxicity.score(empty, training).count() == 0


def toxic_corpus():
    rng = random.Random(7)
    rows, labels = [], []
    for i in range(300):
        w = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.choice('aeiou')}" for _ in range(40)]
        if i % 6 == 0:
            w[:3] = ["nasty", "vile", "foul"]
        rows.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, int(i % 6 == 0)))
    return rows, labels


def test_toxicity_finds_neighbours_without_telling_terms(spark):
    rows, labels = toxic_corpus()
    # Words of the examples, none of them telling: the nearest examples are found all the same, and an unknown text has none.
    rows += [(1000, rows[1][1], "en", "s", 0), (1001, "zzz", "en", "s", 0)]
    out = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert all(len(out[i].evidence) == toxicity.NEIGHBOURS for i in [*range(300), 1000]) and out[1001].evidence == []
    assert out[1000].evidence[0] == 1 and out[1000].score < 0.7


def test_toxicity_cosine_is_that_of_whole_texts(spark):
    rows, labels = toxic_corpus()
    words = ["".join(p) for p in zip("abcdefghij" * 20, "klmnopqrst" * 20, ("xyz" * 67)[:200], sorted("uvwxabcdef" * 20))]
    rows += [(2000, " ".join(["nasty", *words]), "en", "s", 0), (2001, " ".join(words[:50]), "en", "s", 0)]
    model = toxicity.fit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int"))
    df = collections.Counter(t for r in rows for t in set(r[1].split()))
    counts = collections.Counter(rows[-2][1].split())
    square, nasty = 0.0, 0.0
    for t, n in counts.items():
        x = (1 + math.log(n)) * (math.log((1 + len(rows)) / (1 + df[t])) + 1)
        if t in model.number:
            nasty = x * model.term_weight[model.number[t]] / (math.log((1 + len(rows)) / (1 + df[t])) + 1)
            square += nasty**2
        else:
            square += (toxicity.LEAST_WEIGHT * x) ** 2
    got = model.vector(counts)
    assert list(got) == [model.number["nasty"]] and got[model.number["nasty"]] == pytest.approx(nasty / math.sqrt(square), rel=1e-6)
    assert got[model.number["nasty"]] < 0.8


def test_licences_inherit_from_the_nearest_directory(spark):
    mit, apache = licences.TEMPLATES["MIT"], licences.TEMPLATES["Apache-2.0"]
    rows = [("a/LICENSE", f"x\n{mit}"), ("a/b/LICENSE.txt", apache), ("a/b/c/f.py", "code"), ("a/g.py", "code\n" * 50), ("h.py", None), ("a/b/own.py", f"# {mit}"), (None, apache), ("a/g.py", "more"), ("ab/k.py", "")]
    out = {r.path: r for r in licences.scan(spark.createDataFrame(rows, "path string, text string").withColumn("line", F.lit(1))).collect()}
    assert {p: (r.licence, r.origin) for p, r in out.items()} == {
        "a/LICENSE": ("MIT", "own"),
        "a/b/LICENSE.txt": ("Apache-2.0", "own"),
        "a/b/c/f.py": ("Apache-2.0", "inherited"),
        "a/g.py": ("MIT", "inherited"),
        "h.py": (None, None),
        "a/b/own.py": ("MIT", "own"),
        None: ("Apache-2.0", "own"),
        "ab/k.py": (None, None),
    }
    assert licences.scan(spark.createDataFrame([], "path string, text string")).count() == 0


def test_licences_of_files_without_a_path_stay_apart(spark):
    mit, apache = licences.TEMPLATES["MIT"], licences.TEMPLATES["Apache-2.0"]
    out = licences.scan(spark.createDataFrame([(None, mit), (None, apache), (None, apache), (None, "code"), (None, None), ("a.py", "x")], "path string, text string")).collect()
    assert collections.Counter((r.path, r.licence, r.origin, r.origin_path) for r in out) == {(None, "MIT", "own", None): 1, (None, "Apache-2.0", "own", None): 2, (None, None, None, None): 2, ("a.py", None, None, None): 1}


def test_licences_over_several_lines(spark):
    import textwrap

    wrap = lambda t, mark="": "\n".join(mark + x for x in textwrap.wrap(t, 70))
    texts = dict(licences.BODIES)
    gpl = next(t for n, t in licences.NOTICES if n == "GPL-3.0" and "program" in t)
    rows = [
        ("a/LICENSE", "Copyright (c) 2020 Some One\n\n" + wrap(texts["MIT"])),
        ("a/x.py", "code"),
        ("b/y.c", "/* y.c\n" + wrap(texts["BSD-3-Clause"], " * ") + "\n */\n" + "int f(void) { return 1; }\n" * 300),
        ("c/z.py", "# z, a tool\n#\n" + wrap(gpl, "# ") + "\n" + "x = 1\n" * 50),
        ("d/COPYING", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 2, June 1991\n\nEveryone is permitted to copy"),
        ("e/LICENSE", wrap(texts["BSD-2-Clause"])),
        ("f/plain.py", "this software is a copy of nothing\n" * 5),
    ]
    out = {r.path: (r.licence, r.origin) for r in licences.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert out == {"a/LICENSE": ("MIT", "own"), "a/x.py": ("MIT", "inherited"), "b/y.c": ("BSD-3-Clause", "own"), "c/z.py": ("GPL-3.0", "own"), "d/COPYING": ("GPL-2.0", "own"), "e/LICENSE": ("BSD-2-Clause", "own"), "f/plain.py": (None, None)}


@pytest.mark.parametrize("file_ids", [2_000, 10**9])
def test_token_files_round_trip(spark, docs, empty, file_ids):
    path = tokenizer_path("byte_bpe_50k.json")
    enc = PieceEncoder(path)
    rows = huffman.encode_corpus(docs, path, file_ids=file_ids).orderBy("start").collect()
    at = 0
    want = sorted(((r[0], enc.whole(r[1] or "") + bytes(4)) for r in corpus()), key=lambda x: x[0])
    assert len(rows) == len(want)
    for r, (i, ids) in zip(rows, want, strict=True):
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids), r.ids_crc32) == (i, at, len(ids) // 4, ids, zlib.crc32(ids))
        at += len(ids) // 4
    assert huffman.encode_corpus(empty, path).count() == 0


def test_code_lengths_are_optimal_and_limited():
    import heapq

    rng = np.random.default_rng(8)
    for n in (1, 2, 3, 200):
        counts = rng.integers(1, 1000, n)
        sizes = huffman.code_lengths(counts).astype(int)
        assert (2.0**-sizes).sum() <= 1
        heap, cost = [int(c) for c in counts], 0
        heapq.heapify(heap)
        while len(heap) > 1:
            a = heapq.heappop(heap) + heapq.heappop(heap)
            cost += a
            heapq.heappush(heap, a)
        assert (counts * sizes).sum() == (cost if n > 1 else counts[0])
    assert huffman.code_lengths(2 ** np.arange(40), 8).max() <= 8


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    import corpus_pipeline as pipeline

    rows = [r for r in corpus() if r[0] != 5]
    folder = f"file://{tmp_path}"
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line dedup", "MinHash near-dedup", "mixing sources to target weights", "best-fit packing"]
    out = pipeline.run(spark, folder).collect()
    # No one is toxic here; of the copies the smallest id stays; packing holds each mixed document's ids.
    assert out and not {10, 11, 12} & {r.doc_id for r in out} and len({(r.sequence_id, r.offset) for r in out}) == len(out)
