"""Deduplication, decontamination, mixing, sharding and search against brute force, with odd inputs."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import ann, chunks, decontaminate, kernels, minhash, mixing, sharding, substring_dedup, suffix_dedup, suffixes, windowdup
from corpusloom.llm import queries as Q
from corpusloom.llm.components import connected_components

from . import brute

CLASH = "chunk bucket reply payload id n component kept score slot shard _k _size size target".split()


def frame(spark, rows, clash=True):
    """doc_id, text, source, and extra columns whose names the operators use themselves."""
    extra = CLASH if clash else []
    schema = ", ".join(["doc_id long", "text string", "source string", *(f"`{c}` int" for c in extra)])
    return spark.createDataFrame([(i, t, f"s{(i or 0) % 3}" if i != 5 else None, *[0] * len(extra)) for i, t in rows], schema)


def corpus(seed=0, docs=60):
    """Texts with shared passages, copies, periodic stretches, odd white space, nulls and empties."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    words = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = [words(rng.randint(20, 60)) for _ in range(5)]
    texts = [None, "", " ", "x", "a " * 200, "a " * 36, "ab " * 40 + "ba", "  ", words(3000), "A" * 700, "A" * 51]
    while len(texts) < docs:
        parts = [words(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(shared), words(rng.randint(0, 20))]
        texts.append(rng.choice([" ", "\n", "\t  "]).join(parts))
        if rng.random() < 0.3:
            texts.append(rng.choice(texts))
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("size", "crowd"), [(50, 4096), (8, 4096), (50, 2), (8, 1)])
def test_suffix_dedup(spark, size, crowd):
    rows = corpus(1)
    found = suffix_dedup.suffix_dedup(frame(spark, rows), size, crowd=crowd).collect()
    assert sorted(map(tuple, found)) == sorted(brute.suffix_dedup(rows, size))


def test_the_order_of_the_suffix_sort_decides(monkeypatch):
    """Repeats are read off neighbours: with a comparator that lies, equal windows are missed."""
    rng = np.random.default_rng(21)
    values = rng.integers(0, 2, 3000).astype(np.uint64)
    units = windowdup.Units(values, np.array([0, 3000]), values.astype(np.uint8))
    window, group = np.arange(2000), np.zeros(2000, np.int64)
    count = lambda: len(np.unique(suffixes.repeat_classes(units, window, group, 12)))
    truth = len({tuple(values[i : i + 12]) for i in window})
    assert count() == truth
    monkeypatch.setattr(suffixes, "compare", lambda prefix, values, a, b, limit: np.where(a < b, -1, 1))  # by place, not by content
    assert count() > truth


def test_sorted_keys_round_trip():
    rng = np.random.default_rng(22)
    for n, bits in ((1, 48), (2, 48), (5, 3), (300, 48), (5000, 30), (70_000, 48), (9, 0)):
        keys = np.sort(rng.integers(0, 1 << bits, n).astype(np.uint64))
        assert (chunks.unpack_sorted(chunks.pack_sorted(keys)) == keys).all() and chunks.packed_count(chunks.pack_sorted(keys)) == n


def test_chunks_and_buckets_grow_with_the_root_of_the_input(monkeypatch):
    for size in (10**9, 3 * 10**10, 10**12, 10**14):
        monkeypatch.setattr(chunks, "size_in_bytes", lambda docs, size=size: size)
        s = chunks.sizes(None)
        assert s.chunk <= 64 << 20 and size / s.parts <= 256 << 20
        assert s.chunk * 0.076 / s.buckets > 10  # keys a row


def test_suffix_dedup_repeated_ids_and_empty_table(spark):
    text = "the quick brown fox jumps over the lazy dog and runs away from it"
    rows = [(3, text), (3, text), (4, text), (None, None)]
    found = {(r["doc_id"], r["n_removed"]) for r in suffix_dedup.suffix_dedup(frame(spark, rows)).collect()}
    assert found == {(3, 0), (4, len(text)), (None, 0)}
    assert suffix_dedup.suffix_dedup(frame(spark, rows).limit(0)).count() == 0


def test_kept_texts(spark):
    text = "the quick brown fox jumps over the lazy dog and runs away from it"
    out = suffix_dedup.suffix_dedup(frame(spark, [(1, text), (2, "new " + text)]), finish=suffix_dedup.kept_texts, schema="doc_id long, kept binary")
    assert {r["doc_id"]: bytes(r["kept"]) for r in out.collect()} == {1: text.encode(), 2: b"new "}


@pytest.mark.parametrize(("seed", "size", "crowd"), [(2, 35, 4096), (3, 35, 1), (3, 5, 4096), (2, 90, 2), (3, 1, 4096)])
def test_substring_dedup(spark, seed, size, crowd):
    rows = corpus(seed)
    found = substring_dedup.substring_dedup(frame(spark, rows), size, crowd=crowd).collect()
    assert sorted(map(tuple, found)) == sorted(brute.substring_dedup(rows, size))


def anchors_in(units, rounds, shared=None):
    """Each window's anchor, -1 for none, and the key of each anchor."""
    first, count, lead, key = substring_dedup.symbol_anchors(35, rounds)(units, shared)
    anchor, at = np.full(len(units.values), -1), np.zeros(len(units.values), np.uint64)
    anchor[kernels.ranges(first, count)] = np.repeat(first + lead, count)
    at[first + lead] = key
    return anchor, at


def test_words_with_one_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(kernels, "word_hashes", lambda data, start, end: (end - start).astype(np.uint64))
    text = b"ab cd ab x y x abc"
    word, sizes, table, docs = substring_dedup.word_table(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    begin = np.cumsum(sizes) - sizes
    assert [bytes(table[begin[w] : begin[w] + sizes[w]]) for w in word] == [x + b" " for x in text.split()] and list(docs) == [0, 7]


def symbols_in(units, first, size, rounds):
    """Symbols of the last round as (offset in the window, words, name), if their start lies in the window."""
    names, starts, sizes, _ = substring_dedup.recompress(units, rounds)[-1]
    return {(int(s) - first, int(z), int(n)) for n, s, z in zip(names, starts, sizes, strict=True) if 0 <= s - first < size}


@pytest.mark.parametrize("letters", ["aab", "abc", "abcdefgh"])
def test_recompression_names_the_middle_of_a_window_alike(letters):
    """Equal windows have equal symbols but for the stated margin, and anchors at equal places with equal keys."""
    rng = np.random.default_rng(4)
    rounds = substring_dedup.rounds_for(35)
    assert rounds == (("run", 2), ("pair", 4), ("pair", 8))
    lost, _ = substring_dedup.margins(rounds)[-1]
    for _ in range(150):
        window = " ".join(rng.choice([*letters], 35))
        contexts = [" ".join(rng.choice([*letters], n)) for n in rng.integers(1, 30, 4)]
        text = f"{contexts[0]} {window} {contexts[1]}\0{contexts[2]} {window} {contexts[3]}".split("\0")
        data = np.frombuffer("".join(text).encode(), np.uint8)
        units = substring_dedup.word_units(data, np.array([0, len(text[0]), len(data)]))
        anchor, key = anchors_in(units, rounds)
        a, b = len(contexts[0].split()), int(units.offsets[1]) + len(contexts[2].split())
        assert anchor[a] - a == anchor[b] - b and key[anchor[a]] == key[anchor[b]]
        inside = [{x for x in symbols_in(units, at, 35, rounds) if x[0] >= lost and x[0] + x[1] <= 35 - lost} for at in (a, b)]
        assert inside[0] == inside[1] and max(z for _, z, _ in inside[0]) <= 8


def test_lone_symbols_drop_only_windows_that_occur_once():
    rng = np.random.default_rng(23)
    rounds = substring_dedup.rounds_for(35)
    for _ in range(20):
        shared = " ".join(f"w{x}" for x in rng.integers(0, 30, 60))
        texts = [f"{' '.join(f'u{x}' for x in rng.integers(0, 10**9, 40))} {shared} {' '.join(f'u{x}' for x in rng.integers(0, 10**9, 40))}" for _ in range(2)]
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        units = substring_dedup.word_units(data, np.array([0, len(texts[0]), len(data)]))
        names = substring_dedup.lower_names(rounds)(units)
        twice = np.isin(names, [n for n, c in zip(*np.unique(names, return_counts=True), strict=True) if c > 1])
        anchor, _ = anchors_in(units, rounds, twice)
        assert (anchor[40 : 40 + 26] >= 0).all() and (anchor[180 : 180 + 26] >= 0).all() and (anchor >= 0).sum() < 105


def test_suffix_sort_orders_suffixes():
    rng = np.random.default_rng(5)
    values = rng.integers(0, 3, 4000).astype(np.uint64)
    start = rng.integers(0, 3900, 300)
    group = np.sort(rng.integers(0, 5, 300))
    order = suffixes.sort_suffixes(kernels.Prefix(values), values, start, group, 40)
    key = [(group[i], tuple(values[start[i] : start[i] + 40])) for i in order]
    assert key == sorted(key) and sorted(order) == list(range(300))


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(spark, width):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(0, None), (1, ""), (2, "one"), (3, "ONE"), (4, "one two"), (5, "One\ttwo"), (6, " ".join(rng.choices(vocabulary, k=2500)))]
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(5, 90))
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 1 + len(base) // 12)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    found = minhash.near_duplicates(frame(spark, rows), width).collect()
    assert sorted(map(tuple, found)) == sorted(brute.near_duplicates(rows, width, 80))


def test_chain_of_links_and_blocks(spark):
    """A chain in which only neighbours are alike is one component, however small the blocks."""
    words = [f"t{i}" for i in range(160)]
    rows = [(i, " ".join(words[i * 2 : i * 2 + 60])) for i in range(40)]
    found = minhash.near_duplicates(frame(spark, rows), 2, block=3).collect()
    assert sorted(map(tuple, found)) == sorted(brute.near_duplicates(rows, 2, 80))


def test_components_of_long_chains(spark):
    """Chains of some hundreds settle in whatever order their ids come, one with the smallest id at its far end too."""
    chains = [list(range(1, 200)) + [0], list(range(1000, 1400)), list(range(2000, 2100))]
    random.Random(19).shuffle(chains[1])
    edges = [(a, b) for c in chains for a, b in zip(c[:-1], c[1:], strict=True)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted(map(tuple, found.collect())) == sorted((i, min(c)) for c in chains for i in c)


def test_sketch_drops_fewer_pairs_than_the_bands_miss():
    """Exact chance that two sketches of similarity 0.8 differ in more bits than the bound allows."""
    samples, bits = minhash.BANDS * minhash.ROWS, minhash.SKETCH_BITS
    most = np.flatnonzero(minhash.estimate(np.arange(bits // 2)) >= 0.8 - minhash.LEAST_ESTIMATE)[-1]
    odd, i, dropped = np.zeros(bits + 1), np.arange(bits + 1), 0.0
    odd[0] = 1
    for d in range(samples + 1):  # d samples differ: each flips a random bit in either sketch
        dropped += math.comb(samples, d) * 0.2**d * 0.8 ** (samples - d) * odd[most + 1 :].sum()
        for _ in range(2):
            flipped = np.zeros(bits + 1)
            flipped[1:] += odd[:-1] * (bits - i[:-1]) / bits
            flipped[:-1] += odd[1:] * i[1:] / bits
            odd = flipped
    assert dropped < (1 - 0.8**minhash.ROWS) ** minhash.BANDS


def test_keep_one(spark):
    rows = [(7, "a b c d e f g"), (8, "a b c d e f g"), (9, "z y x w v u"), (9, "z y x w v u"), (None, "q"), (10, None)]
    docs = frame(spark, rows)
    kept = minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["10", "7", "9", "None"]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_an_id_with_several_texts_loses_no_link(spark):
    """Rows of one id are versions of one document: each text's links count, and one row of the id stays."""
    words = [f"w{i}" for i in range(90)]
    a, b = " ".join(words[:40]), " ".join(words[45:85])
    rows = [(1, a), (1, b), (2, a), (3, b), (4, a + " x"), (5, b + " y"), (6, "else where"), (8, "p q r s t u v w"), (7, "p q r s t u v w"), (8, "k l m n o"), (9, "k l m n o")]
    for order in (rows, rows[::-1]):
        found = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(frame(spark, order), 2).collect()}
        assert found == {(i, len(brute.shingles(t, 2)), 1 if i < 6 else 6 if i == 6 else 7) for i, t in rows}
        kept = sorted((r["doc_id"], r["text"]) for r in minhash.keep_one(frame(spark, order), 2).collect())
        assert kept == [(1, a), (6, "else where"), (7, "p q r s t u v w")]


def test_myers():
    rng = random.Random(7)
    for _ in range(150):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 70)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 90)))
        assert decontaminate.myers(item, text, -1) == brute.edit_distance_within(item, text)


def test_decontamination(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    items = [(k, " ".join(rng.choices(words, k=30))) for k in range(8)] + [(90, None), (91, " "), (None, "only once seen phrase of no id"), (92, "tiny")]
    rows = [(0, None), (1, ""), (2, " ".join(rng.choices(words, k=4000)))]
    for k, item in items[:8]:
        for edits in (0, 1, len(item) // 40, len(item) // 13, len(item) // 10 + 20):
            broken = list(item)
            for _ in range(edits):
                broken[rng.randrange(len(broken))] = rng.choice("xyz")
            rows.append((len(rows), " ".join(rng.choices(words, k=20)) + "\n" + "".join(broken).upper() + " tail"))
    docs = frame(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = {}
    for i, text in rows:
        text = decontaminate.normalise(text)
        parsed = decontaminate.Items.of(items, 0.1, 12)
        hit = [x for x, t, e in zip(parsed.ids, parsed.texts, parsed.errors, strict=True) if brute.edit_distance_within(t, text) <= e]
        expected[i] = (len(hit), sorted(x for x in hit if x is not None))
    for block in (8 << 20, 2000):
        found = decontaminate.contaminated(docs, bench, block_bytes=block).collect()
        assert {r["doc_id"]: (r["n_items"], r["item_ids"]) for r in found} == expected
        clean = decontaminate.keep_clean(docs, bench, block_bytes=block)
        assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {i for i, (n, _) in expected.items() if not n}
    assert decontaminate.contaminated(docs, bench.limit(0)).where("contaminated").count() == 0


def test_decontamination_grants_the_whole_error_rate():
    """The budget is a tenth of the characters at any length, whatever the pieces' length."""
    rng = random.Random(18)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    for n in (9, 10, 19, 20, 23, 40, 95, 167, 233, 305):
        item = " ".join(rng.choices(words, k=n))[:n].strip().ljust(n, "j")
        matcher = decontaminate.Matcher(decontaminate.Items.of([(1, item)], 0.1, 12))
        for _ in range(20):
            for edits in (n // 10, n // 10 + 1):
                broken = list(item)
                for at in sorted(rng.sample(range(n), edits), reverse=True):  # replaced, lost or put in before
                    broken[at : at + 1] = rng.choice((["z"], [], ["z", broken[at]]))
                text = " ".join(["xx", *rng.choices(words, k=10), "".join(broken), *rng.choices(words, k=10)])
                text = decontaminate.normalise(text)
                assert bool(matcher.matches(text)) == (brute.edit_distance_within(item, text) <= n // 10)


def same_as_sql(docs, out, sql):
    with duckdb.connect() as db:
        db.register("documents", docs.select("doc_id", "text", "source").toArrow())
        wanted = db.execute(sql)
        names = [c[0] for c in wanted.description]
        return sorted(map(str, wanted.fetchall())) == sorted(str(tuple(r)) for r in out.select(names).collect())


def test_mixing(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30))) for i in range(120)] + [(200, None), (201, ""), (17, "w w w")]
    docs = frame(spark, rows)
    plan = mixing.mix_plan(docs)
    assert same_as_sql(docs, plan, mixing.MIX_SQL)
    done = plan.toPandas()
    assert (done.taken <= 3 * done["size"]).all()
    by = done.groupby("source_size").agg(target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert (abs(by.taken - by.target) <= by.most).all()
    copies = mixing.mix(docs)
    assert copies.columns == docs.columns
    assert sum(len((r["text"] or "").split()) for r in copies.collect()) == done.taken.sum()
    assert mixing.mix_plan(docs.limit(0)).count() == 0


def test_water_filling_caps(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 100), ("d", 0)], "k string, source_size long")
    got = {r["k"]: r["target"] for r in mixing.water_fill(sizes, (5, 2, 1), 3).collect()}
    left, weights, caps = 1110.0, {"a": 5, "b": 2, "c": 1, "d": 5}, {"a": 30, "b": 3000, "c": 300, "d": 0}
    want = {}
    while True:  # the loop as stated
        level = left / sum(weights.values())
        over = [k for k in weights if weights[k] * level > caps[k]]
        if not over:
            break
        for k in over:
            want[k] = caps[k]
            left -= caps[k]
            del weights[k]
    want |= {k: w * level for k, w in weights.items()}
    assert got == pytest.approx(want)


def test_sharding(spark):
    table = sharding.lookup_table(["x", "y", "z"], 101)
    assert sorted(np.bincount(table)) == [33, 34, 34]
    fewer = sharding.lookup_table(["x", "y"], 101)
    assert sum(a == b for a, b in zip(table, fewer, strict=True)) > 55
    with pytest.raises(ValueError):
        sharding.lookup_table(["x"], 100)
    docs = frame(spark, [(i, "t") for i in range(300)] + [(None, None), (5, "again")])
    out = sharding.shard(docs)
    assert out.columns == [c for c in docs.columns if c not in ("slot", "shard")] + ["slot", "shard"]
    assert out.count() == 302 and out.where("doc_id = 5").select("shard").distinct().count() == 1
    assert same_as_sql(docs, out.select("doc_id", "slot", "shard"), sharding.shard_sql())
    assert sharding.shard(docs.limit(0)).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(10)
    x = rng.standard_normal((900, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[40] = x[60] = x[61]
    rows = [(i, [float(v) for v in np.float32(r)], 0) for i, r in enumerate(x)]
    rows += [(1000, None, 0), (1020, [0.0] * 24, 0), (1040, [float("nan")] * 24, 0), (1060, [1.0, None] * 12, 0), (1080, [1.0], 0), (1100, [float("inf")] * 24, 0), (40, rows[40][1], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, v int")
    got = ann.nearest(frame).toPandas()
    assert sorted(got.query_id.unique()) == list(range(0, 900, 20))
    y = np.float32(x).astype(float)
    found = 0
    for q, part in got.groupby("query_id"):
        part = part.sort_values("rank")
        assert list(part["rank"]) == list(range(1, len(part) + 1)) and len(part) == 20 and q not in set(part.vec_id) and part.vec_id.is_unique
        s = y @ y[q]
        assert np.allclose(part.score, s[part.vec_id], atol=1e-12) and list(zip(-part.score, part.vec_id, strict=True)) == sorted(zip(-part.score, part.vec_id, strict=True))
        s[q] = -9
        found += len(set(np.lexsort((np.arange(900), -s))[:20]) & set(part.vec_id))
    assert found / (45 * 20) >= 0.9
    plain = frame.select("vec_id", "embedding", *[F.lit(1).alias(c) for c in ("part", "cells", "salt", "t", "cell", "query", "score", "rank")])
    assert sorted(map(tuple, ann.nearest(plain).collect())) == sorted(got.itertuples(index=False, name=None))
    few = ann.nearest(frame.where("vec_id < 5")).toPandas()
    assert len(few) == 4 and ann.nearest(frame.limit(0)).count() == 0


def recall_and_share(x, queries, neighbours=20):
    """Of an index fitted on x: the share of true neighbours in visited cells, and of all rows."""
    index = ann.fit([list(v) for v in x[np.random.default_rng(1).permutation(len(x))[:2000]]], len(x), neighbours)
    own = index.cells(x)
    who, table, cell = index.visits(x[queries])
    scores = x[queries] @ x.T
    scores[np.arange(len(queries)), queries] = -9
    found, compared = [], []
    for i in range(len(queries)):
        seen = np.any([np.isin(own[t], cell[(who == i) & (table == t)]) for t in range(len(own))], axis=0)
        found.append(seen[np.argpartition(-scores[i], neighbours)[:neighbours]].mean())
        compared.append(seen.mean())
    return np.mean(found), np.mean(compared)


def test_clustered_vectors_are_found_in_a_small_share_of_rows():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((300, 64))
    x = centres[rng.integers(0, 300, 20_000)] + 0.25 * rng.standard_normal((20_000, 64))
    recall, share = recall_and_share(x / np.linalg.norm(x, axis=1, keepdims=True), np.arange(0, 20_000, 200))
    assert recall >= 0.9 and share <= 0.2


def test_plain_vectors_keep_their_recall():
    x = np.random.default_rng(4).standard_normal((20_000, 64))
    recall, share = recall_and_share(x / np.linalg.norm(x, axis=1, keepdims=True), np.arange(0, 20_000, 200))
    assert recall >= 0.9 and share <= 0.85


def test_short_queries_are_compared_with_all_rows(spark):
    """Every query gets all candidates, or 20, also where its cells hold fewer; ties go to the smaller id."""
    rng = np.random.default_rng(12)
    for n in (12, 21, 40):
        x = np.float32(rng.standard_normal((n, 8)))
        x[n // 2 :] *= 0.01  # short vectors lie far from all queries
        got = ann.nearest(spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")).toPandas()
        for q in range(0, n, 20):
            part = got[got.query_id == q].sort_values("rank")
            assert len(part) == min(20, n - 1)
            if n <= 21:
                s = x.astype(float) @ x[q].astype(float)
                assert list(part.vec_id) == [i for i in np.lexsort((np.arange(n), -s)) if i != q]


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_its_sql(spark, sf, name):
    out = Q.queries()[name](spark, sf)
    with duckdb.connect() as db:
        db.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
        wanted = db.execute(Q.oracle_sql()[name])
        names = [c[0] for c in wanted.description]
        assert set(names) <= set(out.columns)
        assert sorted(map(str, wanted.fetchall())) == sorted(str(tuple(r)) for r in out.select(names).collect())


@pytest.mark.parametrize(("sql", "plain"), [(suffix_dedup.SUFFIX_SQL, lambda rows: brute.suffix_dedup(rows, 50)), (substring_dedup.SUBSTRING_SQL, lambda rows: brute.substring_dedup(rows, 35)), (minhash.NEAR_SQL, lambda rows: brute.near_duplicates(rows, 2, 80))])
def test_sql_equals_brute_force(sql, plain):
    rows = [(i, t) for i, t in corpus(11) if t is None or len(t) < 4000]
    with duckdb.connect() as db:
        db.execute("create table documents (doc_id bigint, text varchar)")
        db.executemany("insert into documents values (?, ?)", rows)
        assert sorted(db.execute(sql).fetchall()) == sorted(plain(rows))


def test_queries_are_registered():
    names = Q.queries()
    assert [sum(k.startswith(f"op{n}_") for k in names) for n in range(1, 11)] == [1] * 10
