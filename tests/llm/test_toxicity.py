from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.llm.brute import fold
from textlake.llm import toxicity

SCHEMA = "doc_id long, text string"
BAD = ["vile", "filth", "Rotten"]


def cases(seed: int) -> tuple[list[tuple], dict]:
    rng = random.Random(seed)
    words, docs, bad = [f"w{i}" for i in range(300)], [], {}
    for i in range(900):
        sentences = [" ".join(rng.choice(words) for _ in range(rng.randint(2, 12))) for _ in range(rng.randint(1, 30))]
        if rng.random() < 0.2:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(BAD)
            bad[i] = sentences[k]
        docs.append((i, ". ".join(sentences)))
    return docs, bad


def test_held_out_accuracy_and_spans(spark):
    docs, bad = cases(1)
    labels = spark.createDataFrame([(i, 1, int(i in bad)) for i, _ in docs], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame(docs, SCHEMA).withColumn("score", F.lit("x"))
    rows = toxicity.toxic_scores(df, labels).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r["held_out"] == (fold(r["doc_id"], 3) == 1)
        assert r["predicted"] == int(r["score"] >= 0.7)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == (r["doc_id"] in bad) for r in held) >= 0.99 * len(held)
    texts = dict(docs)
    hits = 0
    for r in toxicity.score(df, toxicity.train(df, labels)).where("score >= 0.7").collect():
        spans = [texts[r["doc_id"]].encode()[s["begin"] : s["end"]].decode().strip() for s in r["offending"]]
        hits += spans == [bad.get(r["doc_id"])]
    assert hits >= 0.97 * len(bad)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxic_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    # some 35 toxic documents to learn from
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.93 * len(rows)


def test_defined_results(spark):
    docs, bad = cases(2)
    labels = [(i, int(i in bad)) for i, _ in docs]
    odd = [(5000, None), (5001, ""), (5002, "..\n!"), (None, "vile"), (5003, "vile"), (5003, "vile"), (5004, "ok. " * 300)]
    kind = "doc_id long, toxic int"
    known = spark.createDataFrame([*labels, *labels, (5000, None), (None, 1), (5001, 7)], kind)
    rows = {(r["doc_id"], r["score"]): r for r in toxicity.toxic_scores(spark.createDataFrame(docs + odd, SCHEMA), known).collect()}
    by_id = {k[0]: r for k, r in rows.items()}
    assert by_id[5000]["score"] == by_id[5001]["score"] == by_id[5002]["score"] == 0.0
    assert by_id[None]["score"] == by_id[5003]["score"] >= 0.7
    assert by_id[None]["held_out"] is False and by_id[5004]["predicted"] == 0
    for none in (spark.createDataFrame([], kind), spark.createDataFrame([(i, 0) for i, _ in docs], kind)):
        found = toxicity.toxic_scores(spark.createDataFrame(docs[:5], SCHEMA), none).collect()
        assert [r["predicted"] for r in found] == [0] * 5
    assert toxicity.toxic_scores(spark.createDataFrame([], SCHEMA), known).count() == 0


def test_stage_keeps_clean_rows(spark):
    docs, bad = cases(3)
    df = spark.createDataFrame(docs, SCHEMA).withColumn("score", F.lit("own"))
    labels = spark.createDataFrame([(i, int(i in bad)) for i, _ in docs], "doc_id long, toxic int")
    kept = toxicity.drop_toxic(df, labels)
    assert kept.columns == df.columns
    found = {tuple(r) for r in kept.collect()}
    assert len(found ^ {(*d, "own") for d in docs if d[0] not in bad}) <= 5


def test_a_bag_without_known_words_is_clean():
    import numpy as np

    empty = toxicity.bag(np.empty(0, "uint8"), np.zeros(3, "int64"))
    model = toxicity.fit(empty, np.array([1.0, 0.0]))
    assert model.sentence_logits(empty).size == 0 and model.bias == pytest.approx(-50)


def test_length_is_no_evidence(spark):
    docs, bad = cases(4)
    labels = spark.createDataFrame([(i, int(i in bad)) for i, _ in docs], "doc_id long, toxic int")
    rng = random.Random(5)
    clean = ". ".join(" ".join(rng.choice([f"w{i}" for i in range(300)]) for _ in range(8)) for _ in range(100_000))
    long = [(9000, clean), (9001, "none of it. " * 100_000), (9002, clean + ". so vile"), (9003, "!a" * 100_000)]
    df = spark.createDataFrame(docs + long, SCHEMA)
    rows = {r["doc_id"]: r for r in toxicity.toxic_scores(df, labels).collect()}
    assert [rows[i]["predicted"] for i in (9000, 9001, 9002, 9003)] == [0, 0, 1, 0]
    # words that no labelled text has say nothing: the base rate is left
    assert 0 < rows[9001]["score"] == rows[9003]["score"] < 0.2 and rows[9002]["n_offending"] == 1


def test_rare_words_of_many_labels(spark):
    rng = random.Random(6)
    words, docs, bad = [f"w{i}" for i in range(300)], [], set()
    for i in range(3000):
        text = " ".join(rng.choice(words) for _ in range(40))
        if rng.random() < 0.11:
            bad.add(i)
            text += f". such x{len(bad) % 55}"  # some four of each outside the held-out fold
        docs.append((i, text))
    labels = spark.createDataFrame([(i, int(i in bad)) for i, _ in docs], "doc_id long, toxic int")
    rows = toxicity.toxic_scores(spark.createDataFrame(docs, SCHEMA), labels).collect()
    found = {r["doc_id"] for r in rows if r["predicted"]}
    assert len(found & bad) >= 0.85 * len(bad) and len(found - bad) <= 5


def test_few_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxic_scores(docs, labels).join(labels, "doc_id").collect()
    # words of three toxic texts and more are learned, nothing is rejected for its length
    assert sum(r["predicted"] for r in rows if r["toxic"] == 1) >= 6
    assert not any(r["predicted"] for r in rows if r["toxic"] == 0)


def test_a_text_that_does_not_fit_is_left_out_alone(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_BYTES", 6_000)
    monkeypatch.setattr(toxicity, "RANGE", 50, raising=False)
    docs, bad = cases(7)
    docs += [(i, ". ".join(" vile" * k for k in range(1, 120))) for i in range(2000, 2030)]
    bad |= {i: "" for i in range(2000, 2030)}
    labels = spark.createDataFrame([(i, int(i in bad)) for i, _ in docs], "doc_id long, toxic int")
    rows = toxicity.toxic_scores(spark.createDataFrame(docs, SCHEMA), labels).collect()
    assert sum(r["predicted"] == (r["doc_id"] in bad) for r in rows) >= 0.98 * len(rows)


def test_weak_words_do_not_add_up():
    import numpy as np

    text = ". ".join(f"weak{i}" for i in range(100_000)).encode()
    data = np.frombuffer(text + b". vile", "uint8")
    b = toxicity.bag(data, np.array([0, len(text), len(data)]))
    words, which = np.unique(b.word, return_inverse=True)
    weights = np.full(len(words), 4.0)  # 0.05 a sentence
    weights[which[-1]] = 12.0
    model = toxicity.Model(words, weights)
    hazard, once = model.hazards(b)
    # the likeliest of the weak ones counts, and all that offend
    assert hazard[:100_000].sum() > 100 and b.text[once].tolist() == [0, 1]
    scores, _ = model.scores(b, 2)
    assert scores[0] < 0.1 and scores[1] > 0.99


def test_sentences_that_count():
    import numpy as np

    hazard = np.array([0.1, 2.0, 0.3, 0.3, 0.0, 0.9, 0.7, 0.2])
    text = np.array([0, 0, 0, 0, 1, 2, 2, 3])
    assert toxicity.counting(hazard, text).tolist() == [False, True, True, False, True, True, True, True]
    assert toxicity.counting(np.empty(0), np.empty(0, "int64")).tolist() == []


def test_score_is_the_noisy_or(spark):
    """By a plain loop over sentences and words, of the learned model."""
    import math
    import re

    import numpy as np

    docs, bad = cases(8)
    labels = spark.createDataFrame([(i, int(i in bad)) for i, _ in docs], "doc_id long, toxic int")
    df = spark.createDataFrame(docs, SCHEMA)
    model = toxicity.train(df, labels)
    weights = dict(zip(model.words.tolist(), model.weights.tolist(), strict=True))

    def hashed(word):
        data = np.frombuffer(word.encode(), "uint8")
        return int(toxicity.bag(data, np.array([0, len(data)])).word[0])

    def expected(text):
        said, every = {}, set()
        for sentence in re.split(r"[\r\n!.?]", text):
            ids = [hashed(w) for w in re.findall(r"[0-9A-Za-z]+", sentence)]
            every |= {i >> 46 for i in ids}
            own = tuple(i for i in ids if i in weights)
            if own:
                said[own] = math.log1p(math.exp(-7 + sum(weights[i] for i in own))) - math.log1p(math.exp(-7))
        offend = [h for h in said.values() if 1 - math.exp(-h) >= 0.5]
        weak = [h for h in said.values() if 1 - math.exp(-h) < 0.5]
        moved = sum(model.background[i] for i in every)
        ground = math.log1p(math.exp(model.base + toxicity.SWAY * moved / (1 + abs(moved))))
        return 1 - math.exp(-sum(offend) - max(weak, default=0) - ground)

    texts = dict(docs[:150])
    rows = toxicity.toxic_scores(df, labels).where("doc_id < 150").collect()
    assert len(rows) == 150 and all(abs(r["score"] - expected(texts[r["doc_id"]])) < 1e-9 for r in rows)


def test_clean_texts_are_ranked(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxic_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r["score"] for r in rows if r["toxic"] == k] for k in (0, 1))
    area = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / len(good) / len(bad)
    assert area >= 0.93
    scores = [r["score"] for r in rows]
    assert max(scores.count(x) for x in set(scores)) < 0.1 * len(scores)
