"""The learned operators: held-out accuracy, odd inputs, and the pipeline's stages."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpusloom.llm import decontaminate, langid, minhash, mixing, quality, sharding, toxicity

from . import brute


def text(rng, kind="plain"):
    words = ["".join(rng.choice(["the", "an", "ti", "on", "er", "re", "sh"]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(20, 120))]
    if kind == "shout":
        return " ".join(w.upper() + "!!" for w in words)
    if kind == "repeat":
        return " ".join(w for w in words[:8] for _ in range(9))
    if kind == "signs":
        return " ".join(w + "%%%" for w in words)
    return " ".join(words).capitalize() + "."


def labelled(spark, n=400, seed=0):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        bad = rng.random() < 0.2
        toxic = rng.random() < 0.25
        t = text(rng, rng.choice(["shout", "repeat", "signs"]) if bad else "plain")
        if toxic:
            w = t.split()
            w.insert(len(w) // 2, rng.choice(["idiot", "moron", "id-iot", "morron", "IDIOT!"]))
            t = " ".join(w)
        docs.append((i, t, "en", f"s{i % 3}", len(t)))
        if i % 5 < 3:
            labels.append((i, int(not bad), int(toxic)))
    docs += [(n, None, None, None, None), (n + 1, "", "en", "s", 0), (None, "no id at all", "en", "s", 3), (n + 2, "x " * 20000, "en", "s", 40000), (0, docs[0][1], "en", "s0", 1)]
    labels += [(None, 1, 0), (1, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(docs, schema), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def check_scores(rows, modulus, remainder, threshold):
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= threshold)
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == remainder)


def test_quality(spark):
    docs, labels = labelled(spark)
    model = quality.train_quality(docs, labels)
    rows = quality.score_quality(docs.withColumn("score", docs.doc_id), model).collect()
    assert len(rows) == docs.count()
    check_scores(rows, 3, 1, 0.5)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert len(held) > 40 and np.mean([a == b for a, b in held]) > 0.93
    assert quality.train_quality(docs, labels.limit(0)) is None
    assert {r["score"] for r in quality.score_quality(docs, None).collect()} == {0.5}
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in rows)
    assert quality.score_quality(docs.limit(0), model).count() == 0


def test_risk_never_uses_negatives():
    """Positive and unlabelled rows suffice to find the negatives among the unlabelled."""
    rng = np.random.default_rng(1)
    positive = rng.normal(1, 1, (1500, 5))
    unlabelled = np.concatenate([rng.normal(1, 1, (1400, 5)), rng.normal(-1.5, 1, (600, 5))])
    model = quality.fit_nnpu(positive, unlabelled, 0.7)
    assert (model.score(rng.normal(1, 1, (500, 5))) >= 0.5).mean() > 0.9
    assert (model.score(rng.normal(-1.5, 1, (500, 5))) < 0.5).mean() > 0.9


@pytest.mark.parametrize("prior", [0.3, 1.2])  # no prior exceeds 1, but this one surely clips
def test_gradient_is_that_of_the_risk(prior):
    """Finite differences of the non-negative risk, where its bracket is positive and where it is clipped."""
    rng = np.random.default_rng(8)
    positive, unlabelled = rng.normal(0.5, 1, (12, 4)), rng.normal(0, 1, (15, 4))
    p = [rng.normal(0, 0.6, (4, 3)), rng.normal(0, 0.3, 3), rng.normal(0, 0.8, 3), rng.normal(0, 0.3, 1)]

    def score(p, x):
        return 1 / (1 + np.exp(-(np.tanh(x @ p[0] + p[1]) @ p[2] + p[3][0])))

    def plain(p):
        bracket = score(p, unlabelled).mean() - prior * score(p, positive).mean()
        decay = 0.5e-4 * ((p[0] ** 2).sum() + (p[2] ** 2).sum())
        return (prior * (1 - score(p, positive)).mean() + bracket if bracket >= 0 else -bracket) + decay, bracket

    value, found = quality.gradient(p, positive, unlabelled, prior)
    assert value == pytest.approx(plain(p)[0]) and (plain(p)[1] < 0) == (prior == 1.2)
    for i, part in enumerate(p):
        for at in np.ndindex(part.shape):
            step = [a.copy() for a in p]
            step[i][at] += 1e-6
            up = plain(step)[0]
            step[i][at] -= 2e-6
            assert found[i][at] == pytest.approx((up - plain(step)[0]) / 2e-6, abs=1e-6)
    risk = prior * (1 - score(p, positive)).mean() + max(0, plain(p)[1])
    assert quality.risk(score(p, positive), score(p, unlabelled), prior) == pytest.approx(risk)


def test_quality_of_fully_labelled_documents_and_untouched_held_out_labels(spark):
    """A model is fitted where every document has a label, and held-out labels change nothing."""
    docs, labels = labelled(spark, 250, 7)
    first = quality.train_quality(docs, labels)
    every = docs.select("doc_id").where("doc_id is not null").distinct().selectExpr("doc_id", "1 as quality")
    held = [r[0] for r in every.select("doc_id").collect() if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    turned = labels.where(~labels.doc_id.isin(held)).unionByName(spark.createDataFrame([(i, 0, 0) for i in held], labels.schema))
    again = quality.train_quality(docs, turned)
    assert all(np.array_equal(a, b) for a, b in zip(vars(first).values(), vars(again).values(), strict=True))
    model = quality.train_quality(docs, labels.select("doc_id", "quality").unionByName(every.join(labels, "doc_id", "left_anti")))
    assert model is not None and len({r["score"] for r in quality.score_quality(docs, model).collect()}) > 50


def test_toxicity(spark):
    docs, labels = labelled(spark, 600, 1)
    machine = toxicity.train_toxicity(docs, labels)
    rows = toxicity.score_toxicity(docs.withColumn("score", docs.doc_id), machine).collect()
    assert len(rows) == docs.count()
    check_scores(rows, 4, 2, 0.3)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and truth.get(r["doc_id"]) is not None]
    assert len(held) > 40 and np.mean([a == b for a, b in held]) > 0.95
    assert toxicity.train_toxicity(docs, labels.limit(0)) is None
    data = "he is an i d i o t really\0you idxiot\0the ti on er".split("\0")
    score = toxicity.score_toxicity(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string"), machine).orderBy("doc_id").collect()
    assert score[0]["predicted"] == 1 and score[1]["score"] > score[2]["score"]
    assert toxicity.score_toxicity(docs.limit(0), machine).count() == 0


def test_kernel_map_equals_kernel():
    """The Nystrom decision through the table equals weights times explicit kernel values."""
    words = ["idiot", "idxiot", "table", "i"]
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    cls, at, _ = toxicity.tokens(data, np.array([0, len(data)]))
    word, index, value, norm = toxicity.vectors(cls, at)
    rows = [dict(zip(index[word == k], value[word == k], strict=True)) for k in range(len(words))]
    kernel = lambda a, b: sum(v * rows[b].get(u, 0) for u, v in rows[a].items()) / (norm[a] * norm[b])
    assert kernel(0, 0) == pytest.approx(1) and kernel(0, 1) > 0.3 > kernel(0, 2)
    table = np.zeros(toxicity._TABLE_SIZE)
    for u, v in rows[0].items():
        table[u] = v / norm[0]
    assert toxicity.sums(table, cls, at) / norm == pytest.approx([kernel(k, 0) for k in range(len(words))])


def languages(n=160, seed=2):
    rng = random.Random(seed)
    parts = {"aa": ["tion", "the", "wh", "ing"], "bb": ["sch", "ung", "keit", "der"], "cc": ["eau", "que", "oi", "ment"]}
    word = lambda k: "".join(rng.choice(parts[k]) for _ in range(rng.randint(1, 3)))
    return [(i, "\n".join(" ".join(word(k) for _ in range(rng.randint(3, 25))) for _ in range(rng.randint(1, 5))), k) for i in range(n) for k in [sorted(parts)[i % 3]]], word


def test_language(spark):
    rows, word = languages()
    odd = [(500, None, "aa"), (501, "", "aa"), (502, "123 !?", "aa"), (503, "—…", None), (None, "the whing", "aa"), (504, "the " * 5000, None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("score", 1 * rows[0][0] + F.col("doc_id"))
    tagger = langid.train_tagger(docs)
    found = {r["doc_id"]: r for r in langid.label_language(docs, tagger).collect()}
    assert len(found) == len(rows) + len(odd)
    held = [found[i]["lang_pred"] == k for i, _, k in rows if found[i]["held_out"]]
    assert len(held) > 30 and np.mean(held) > 0.97
    assert all(found[i]["lang_pred"] == "und" and found[i]["score"] == 0 for i in (500, 501, 502, 503))
    assert found[504]["lang_pred"] == "aa" and langid.label_language(docs.limit(0), tagger).count() == 0
    assert {r["lang_pred"] for r in langid.label_language(docs, None).collect()} == {"und"}
    # code-switched: words change language within a line
    line = [word("aa") for _ in range(15)] + [word("cc") for _ in range(15)]
    data, offsets = np.frombuffer(" ".join(line).encode(), np.uint8), np.array([0, len(" ".join(line).encode())])
    p, _ = tagger.tag(data, offsets)
    guess = [tagger.languages[k] for k in p.argmax(1)]
    assert np.mean([g == w for g, w in zip(guess, ["aa"] * 15 + ["cc"] * 15, strict=True)]) > 0.85


def test_forward_backward_is_exact():
    rng = np.random.default_rng(3)
    emission, transition, initial = rng.normal(size=(7, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    heads = np.array([0, 4])
    got, edges, _, log_z = langid.posteriors(emission, heads, transition, initial, pairs=True)
    total = 0.0
    for s, e in ((0, 4), (4, 7)):
        paths = np.array(np.meshgrid(*[range(3)] * (e - s), indexing="ij")).reshape(e - s, -1).T
        w = np.exp([initial[p[0]] + sum(emission[s + t, p[t]] for t in range(e - s)) + sum(transition[p[t], p[t + 1]] for t in range(e - s - 1)) for p in paths])
        for t in range(e - s):
            for k in range(3):
                assert got[s + t, k] == pytest.approx(w[paths[:, t] == k].sum() / w.sum())
        total += np.log(w.sum())
    assert log_z == pytest.approx(total) and edges.sum() == pytest.approx(5)


CLASH = ["size", "target", "_k", "_kept_id", "kept", "component", "score", "_times", "_row", "n", "slot_", "words"]


@pytest.mark.parametrize("number", range(5))
def test_stages_take_odd_tables(spark, tmp_path, number):
    """Each stage: an empty table, nulls in every column, a very long text, repeated rows, ties and clashing names."""
    docs, labels = labelled(spark, 120, 9)
    for name, table in (("labels", labels), ("benchmark", spark.createDataFrame([(0, "a phrase of the benchmark that is nowhere else"), (1, None), (None, "")], "item_id long, text string"))):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    stage = corpus_pipeline.STAGES[number][1]
    odd = [(5000, "word " * 200_000, "en", "s1", 1_000_000), (5001, "tie", "en", None, 3), (5002, "tie", None, "s2", 3), (None, None, None, None, None), (5003, "", "", "", 0), (5003, "", "", "", 0)]
    rows = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    rows = rows.select("*", *[F.lit(7).alias(c) for c in CLASH])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = stage(spark, rows, str(tmp_path))
    assert out.columns[: len(rows.columns)] == rows.columns
    got = out.collect()
    assert got and all(r[c] == 7 for r in got for c in CLASH)
    texts = {(r["doc_id"], r["text"]) for r in rows.select("doc_id", "text").collect()}
    assert {(r["doc_id"], r["text"]) for r in got} <= texts
    if number in (1, 2, 4):  # these drop nothing of the odd rows but copies
        assert any(r["doc_id"] == 5000 and len(r["text"]) == 1_000_000 for r in got) and any(r["doc_id"] is None for r in got)
    empty = stage(spark, rows.limit(0), str(tmp_path))
    assert empty.columns[: len(rows.columns)] == rows.columns and empty.count() == 0


def test_pipeline(spark, tmp_path):
    docs, labels = labelled(spark, 300, 5)
    rng = random.Random(6)
    item = " ".join(text(rng).split()[:18])
    extra = [(2000 + 10 * k, " ".join(text(rng).split()[:40]) + " " + item + " and more.", "en", "s1", 1) for k in range(3)]
    extra.insert(1, (2001, text(rng), "en", "s1", 1))
    extra += [(2002, extra[1][1], "en", "s2", 1)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    for name, table in (("documents", docs), ("labels", labels), ("benchmark", spark.createDataFrame([(0, item)], "item_id long, text string"))):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    sf = str(tmp_path)
    rows = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.train_quality(rows, labels)
    at = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, rows, sf).write.parquet(str(tmp_path / f"stage {len(at)}"))
        after = spark.read.parquet(str(tmp_path / f"stage {len(at)}"))
        at[len(at)] = (rows.collect(), after.collect())
        assert after.columns[:5] == docs.columns
        rows = after
    first, second, third, fourth, fifth = (at[k] for k in range(5))
    good = {r["doc_id"] for r in quality.score_quality(spark.read.parquet(f"{sf}/documents.parquet"), model).collect() if r["predicted"]}
    assert {r["doc_id"] for r in first[1]} == good
    known = [(r["doc_id"], r["text"]) for r in second[0] if r["doc_id"] is not None]
    want = {i for i, _, _, kept in brute.near_duplicates(known, 5, 80) if kept} | {r["doc_id"] for r in second[0] if r["doc_id"] is None}
    assert sorted(map(str, (r["doc_id"] for r in second[1]))) == sorted(map(str, want))
    clean = [r for r in third[0] if decontaminate.normalise(item) not in decontaminate.normalise(r["text"])]
    assert sorted(map(str, clean)) == sorted(map(str, third[1])) and len(third[0]) - 3 <= len(clean) < len(third[0])
    plan = {r["doc_id"]: r for r in mixing.mix_plan(spark.createDataFrame(fourth[0], docs.schema)).collect()}
    taken = sum(r["taken"] for r in plan.values())
    assert sum(len((r["text"] or "").split()) for r in fourth[1]) == taken
    table = sharding.lookup_table()
    assert len(fifth[1]) == len(fifth[0]) and all(r["shard"] == sharding.SHARDS[table[r["slot"]]] for r in fifth[1])
