"""Small inputs with values worked out by hand."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from textlake.functions import text as T
from textlake.operators import (
    bpe, chunks, classify, cleaning, digest, entities, features, modelsel, nextword, profile, quantize, report,
    retrieval, sentiment, sequences, stemming, topics, vectors, vocab,
)
from textlake.plans.staging import new_path, stage
from textlake.sources import files


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "doc_id bigint, text string")


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def one(df):
    return tuple(df.first())


def apply(spark, expression, value):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x"))).first()[0]


def test_tfidf(spark):
    texts = ["blue kites fly", "blue kites blue kites", "rain"]
    found = {(r.doc_id, r.term): r.weight for r in features.tfidf(features.tokenized(docs(spark, *texts))).collect()}
    # idf = ln((1 + documents) / (1 + documents with the term)) + 1
    two, one_doc = math.log(4 / 3) + 1, math.log(4 / 2) + 1
    length = math.sqrt(2 * two**2 + one_doc**2)
    expected = {(1, "blue"): two / length, (1, "kites"): two / length, (1, "fly"): one_doc / length}
    expected |= {(2, "blue"): math.sqrt(0.5), (2, "kites"): math.sqrt(0.5), (3, "rain"): 1.0}
    assert found == pytest.approx(expected)


def test_unseen_documents_drop_unknown_terms_first(spark):
    idf = features.idf_table(features.tokenized(docs(spark, "cat dog", "cat")))
    found = features.tfidf_transform(features.tokenized(docs(spark, "dog zebra zebra", "zebra")), idf)
    assert rows(found.select("doc_id", "term", F.round("weight", 6)), "doc_id") == [(1, "dog", 1.0)]


def test_quantization(spark):
    weights = spark.createDataFrame([(1, [-2.55, 0.0, 1.27, 2.55])], "vec_id int, embedding array<double>")
    row = quantize.dequantize_error(quantize.quantize_int8(weights)).first()
    # 5.1 from the least to the greatest value, over 255 steps
    assert row.scale == pytest.approx(0.02)
    assert row.q[0] == -128 and row.q[3] == 127
    assert [b - a for a, b in zip(row.q, row.q[1:], strict=False)] == pytest.approx([127.5, 63.5, 64], abs=1)
    error = quantize.mean_absolute_error(quantize.dequantize_error(quantize.quantize_int8(weights))).first()[0]
    assert 0 <= error <= 0.02


def test_quantization_of_equal_values_has_no_scale(spark):
    same = spark.createDataFrame([(1, [2.0, 2.0])], "vec_id int, embedding array<double>")
    assert quantize.quantize_int8(same).first().q is None


def test_first_seen_vocabulary(spark):
    table = vocab.word_vocab_first_seen(docs(spark, "owls hunt mice", "owls sleep", "mice hunt seeds at night"))
    ids = {r.token: r.id for r in table.collect()}
    assert ids == {"owls": 3, "hunt": 4, "mice": 5, "sleep": 6, "seeds": 7, "at": 8, "night": 9}
    seqs = vocab.encode_sequences(docs(spark, "owls hunt foxes", "", None), table)
    assert {r.doc_id: (list(r.ids), r.n_unknown) for r in seqs.collect()} == {
        1: ([1, 3, 4, 0, 2], 1), 2: ([1, 2], 0), 3: ([1, 2], 0),
    }
    padded = vocab.pad_sequences(seqs)
    assert {len(r.ids) for r in padded.collect()} == {5}
    strange = spark.createDataFrame([(1, [1, 3, 4, 999, 0, 2])], "doc_id bigint, ids array<int>")
    assert vocab.decode_sequences(strange, table).first().decoded == "owls hunt ?"


def test_characters_round_trip(spark):
    texts = docs(spark, "Zürich été\n", "a😀b", "")
    table = vocab.char_vocab(texts)
    decoded = vocab.char_decode(vocab.char_encode(texts, table), table)
    assert all(r.decoded == r.text for r in decoded.collect())
    outside = vocab.char_encode(docs(spark, "a!"), vocab.char_vocab(docs(spark, "ab")))
    assert list(outside.first().ids) == [0, -1]


def test_text_stages(spark):
    chain = docs(spark, "Hello World").transform(cleaning.upper_stage).transform(cleaning.exclaim_stage)
    assert chain.first().text == "HELLO WORLD!"
    assert apply(spark, T.sentences, "Stop! Who goes there? Nobody. Pass on.") == ["Stop!", "Who goes there?", "Nobody.", "Pass on."]
    assert apply(spark, T.punct_tokens, "It's fine, don't O'Neil!") == ["It", "'s", "fine", ",", "do", "n't", "O'Neil", "!"]
    assert apply(spark, T.word_tokens, "A Über-cool x_1 test") == ["über", "cool", "x_1", "test"]
    assert apply(spark, T.safe_topic, "AI & ML: 2026!") == "AI__ML_2026"
    assert [r.text for r in cleaning.clean_text(docs(spark, "  A \n b ", "  ", None)).collect()] == ["a b"]
    kept = cleaning.remove_stopwords(docs(spark, "").select(F.array(*map(F.lit, ["the", "cat", "the", "cat"])).alias("tokens")))
    assert kept.first().tokens == ["cat", "cat"]
    lemmas = cleaning.lemmatize(docs(spark, "").select(F.array(F.lit("was"), F.lit("cat")).alias("tokens")))
    assert lemmas.first().tokens == ["be", "cat"]


def test_labels_and_missing(spark):
    named = spark.createDataFrame([("spam",), ("ham",), ("x",), (None,)], "l string")
    found = named.select(cleaning.map_labels(F.col("l"), {"spam": 1, "ham": 0}))
    assert [r[0] for r in found.collect()] == [1, 0, None, None]
    holes = spark.createDataFrame([(1, "a"), (2, None), (None, "b")], "i int, s string")
    assert one(cleaning.missing_report(holes)) == (3, 2, 1)
    filled = spark.createDataFrame([(None, None, None)], "title string, url string, content string")
    assert one(cleaning.default_result_fields(filled)) == ("No Title", "", "No content available.")


def test_stems(spark):
    published = {  # word: its stem by the first rule set, as printed with the rules
        "caresses": "caress", "ponies": "poni", "cats": "cat", "plastered": "plaster", "motoring": "motor",
        "conflated": "conflat", "hopping": "hop", "falling": "fall", "happy": "happi", "relational": "relat",
        "digitizer": "digit", "triplicate": "triplic", "allowance": "allow", "controll": "control", "sky": "sky",
    }
    stemmed = stemming.stem_terms(spark.createDataFrame([(w,) for w in published], "term string"))
    found = {r.term: (r.porter, r.snowball, r.lancaster) for r in stemmed.collect()}
    assert {w: stems[0] for w, stems in found.items()} == published
    assert found["cats"] == ("cat", "cat", "cat") and found["motoring"] == ("motor", "motor", "mot")


def test_byte_pairs_equal_a_public_tokenizer(spark):
    tokenizers = pytest.importorskip("tokenizers")
    texts = [
        "the cat and the hat, don't they? aaa aaaa", "Größe über\n\nthe  theatre 123 1234", "banana bandana ban 😀", "the the",
    ]
    public = tokenizers.ByteLevelBPETokenizer()
    specials = ["<s>", "<pad>", "</s>", "<unk>", "<mask>"]
    public.train_from_iterator(texts, vocab_size=300, min_frequency=2, special_tokens=specials)
    table = docs(spark, *texts)
    words = bpe.word_counts(table)
    tokens, merges = bpe.tokenizer_tables(spark, bpe.bpe_train(words, 300))
    assert {r.token: r.id for r in tokens.collect()} == public.get_vocab()
    unseen = docs(spark, *texts, "", "new thé words\x00")
    coded = bpe.bpe_encode(unseen, tokens, merges)
    assert {r.doc_id: list(r.ids) for r in coded.collect()} == {
        r.doc_id: public.encode(r.text).ids for r in unseen.collect()
    }
    back = bpe.bpe_decode(coded, tokens)
    assert rows(back, "doc_id") == rows(unseen, "doc_id")


def seq(spark, *ids):
    return stage(spark.createDataFrame(list(enumerate(ids)), "doc_id bigint, ids array<int>"), "test")


def test_blocks(spark):
    some = seq(spark, [7, 8], [], [9, 10, 11, 12, 13], [14])
    blocks = sequences.token_blocks(some, 3)
    assert [list(r.input_ids) for r in blocks.orderBy("block_id").collect()] == [[7, 8, 9], [10, 11, 12]]
    nine = seq(spark, list(range(9)))
    assert sequences.token_blocks(nine, 3).count() == 3
    assert sequences.token_blocks(nine, 3, strict_compat=True).count() == 2
    split = sequences.contiguous_split(some, 0.75)
    assert [x for r in split.orderBy("doc_id").collect() for x in r.train_ids] == [7, 8, 9, 10, 11, 12]
    assert [x for r in split.orderBy("doc_id").collect() for x in r.val_ids] == [13, 14]


@pytest.mark.parametrize(("n", "windows"), [(1, 1), (256, 1), (257, 2), (384, 2), (385, 3), (512, 3)])
def test_windows(spark, n, windows):
    found = sequences.token_windows(seq(spark, list(range(100, 100 + n))), 256, 128).orderBy("window_no").collect()
    assert len(found) == windows
    seen = {i for r in found for i, m in zip(r.input_ids, r.attention_mask, strict=True) if m}
    assert seen == set(range(100, 100 + n))
    assert all(len(r.input_ids) == len(r.labels) == 256 for r in found)


def test_next_token_samples(spark):
    stream = list(range(1000, 1400))
    found = sequences.next_token_samples(seq(spark, stream[:150], stream[150:]), context=16, batch=4, n_batches=5).collect()
    assert len(found) == 20
    for r in found:
        assert list(r.inputs) == stream[r.start : r.start + 16]
        assert list(r.targets) == stream[r.start + 1 : r.start + 17]


def test_chat(spark):
    turns = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 3, "user", "later"), (2, 0, "user", "x")]
    found = sequences.sft_format(spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string"))
    pad = " " * 24
    assert rows(found, "conv_id") == [
        (1, f"<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n{pad}q<|eot_id|>"
            f"<|start_header_id|>assistant<|end_header_id|>\n{pad}a<|eot_id|>")
    ]


def test_perplexity_guard(spark):
    means = spark.createDataFrame([(0.0,), (19.0,), (20.0,)], "m double").select(nextword.guarded_exp(F.col("m")))
    found = [r[0] for r in means.collect()]
    assert found[0] == 1.0 and found[1] > 1e8 and found[2] == float("inf")


def test_next_token_sets_sum_to_one(spark):
    tokens = features.tokenized(docs(spark, "aa bb aa bb aa cc aa dd", "aa bb"))
    pairs = nextword.pair_table(tokens)
    top = nextword.next_token_top_k(pairs, 2, 0.7).groupBy("prev").agg(F.sum("prob").alias("p"))
    assert all(r.p == pytest.approx(1.0) for r in top.collect())
    kept = nextword.next_token_top_p(pairs, 0.6).where("prev = 'aa'")
    assert rows(kept.select("next"), "next") == [("bb",)]  # three of five reach 0.6


def test_sentiment(spark):
    reviews = docs(spark, "excellent great support", "terrible and slow", "the package", "good bad", "")
    scored = sentiment.sentiment_score(features.tokenized(reviews), sentiment.opinion_lexicon(spark))
    assert [r.label for r in scored.orderBy("doc_id").collect()] == ["POSITIVE", "NEGATIVE", "NEUTRAL", "NEUTRAL", "NEUTRAL"]
    assert one(sentiment.sentiment_summary(scored)) == (5, 1, 1, 20.0, 20.0)
    assert one(sentiment.sentiment_summary(scored.limit(0))) == (0, 0, 0, None, None)


def test_model_hook_is_loaded_per_task(spark):
    def load():
        import pandas as pd

        return lambda texts: pd.DataFrame({"label": ["POSITIVE"] * len(texts), "confidence": texts.str.len() / 7})

    assert rows(sentiment.score_with(docs(spark, "abc"), load), "doc_id") == [(1, "POSITIVE", 0.43)]


def test_entities_longest_leftmost(spark):
    phrases = [("new york", "GPE"), ("new york times", "ORG"), ("york", "PERSON"), ("times square", "GPE"), ("x", "DATE")]
    listed = stage(spark.createDataFrame(phrases, "entity string, type string"), "gaz")
    tokens = docs(spark, "the new york times square york x", "nothing").withColumn("tokens", T.ws_tokens(F.col("text")))
    mentions = entities.entity_mentions(tokens, listed)
    found = rows(mentions.select("start", "len", "type", "entity"), "start")
    assert found == [(1, 3, "ORG", "new york times"), (5, 1, "PERSON", "york")]
    tags = [r.tag for r in entities.iob_tags(tokens, mentions).where("doc_id = 1").orderBy("pos").collect()]
    assert tags == ["O", "B-ORG", "I-ORG", "I-ORG", "O", "B-PERSON", "O"]
    top = entities.top_entities(mentions, 5)
    assert {r.type for r in top.collect()} == {"ORG", "PERSON"}


def test_naive_bayes(spark):
    texts = docs(spark, "win money now", "win prize money", "meeting at noon", "lunch at noon today", "see you at lunch", "zzz")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (4, 0), (5, 0)], "doc_id bigint, label int")
    tokens = features.tokenized(texts)
    model = classify.nb_train(tokens, labels)
    assert model.classes == [0, 1] and model.priors == [0.6, 0.4]
    found = {r.doc_id: r.prediction for r in classify.nb_predict(tokens, model).collect()}
    assert found == {1: 1, 2: 1, 3: 0, 4: 0, 5: 0, 6: 0}  # the last follows the prior
    totals = classify.nb_table(model).groupBy("label").agg(F.sum(F.exp("log_likelihood")).alias("p"))
    assert all(r.p == pytest.approx(1.0) for r in totals.collect())


def test_best_model_ties_go_to_the_first(spark):
    acc = spark.createDataFrame([("B", 1, 0.9), ("A", 0, 0.9), ("C", 2, 0.5)], "model string, ordinal int, accuracy double")
    assert one(modelsel.select_best_model(acc)) == ("A", 0.9)
    report_text = modelsel.model_report(acc).first().report
    assert report_text == "Best model: A with accuracy 0.9000. All accuracies: {'A': 0.9000, 'B': 0.9000, 'C': 0.5000}"


def test_empty_lists_are_empty(spark):
    tokens = docs(spark, "").select(F.array(*map(F.lit, ["the", "was"])).alias("tokens"))
    assert cleaning.remove_stopwords(tokens, []).first().tokens == ["the", "was"]
    assert cleaning.lemmatize(tokens, {}).first().tokens == ["the", "was"]
    assert sentiment.opinion_lexicon(spark, {}).count() == 0


def test_many_bins(spark):
    table = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    found = profile.rate_by_bin(table, "v", F.col("v") >= 500, 250)
    assert found.count() == 250
    assert {r.n for r in found.collect()} == {4}


def test_digests_with_equal_names_are_kept_apart(spark):
    digests = spark.createDataFrame([("A!", "one"), ("A?", "two"), ("B", "three")], "topic string, digest string")
    back = files.write_digest_files(digests, new_path(spark, "digests"), "t")
    assert rows(back, "name") == [("t_A", "one\n"), ("t_A_2", "two\n"), ("t_B", "three\n")]


def test_quantiles_interpolate(spark):
    table = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (10.0,), (None,)], "v double")
    row = profile.numeric_summary(table, ["v"]).first()
    assert (row.n, row.q25, row.q50, row.q75) == (4, 1.75, 2.0, 4.0)


@pytest.mark.parametrize("text", [
    "", "short", "".join(f"{i:04d}" for i in range(425)), " ".join(f"word{i}" for i in range(400)),
    " ".join(f"One {i}." for i in range(40)) + "\n\n" + " ".join(f"Two {i}." for i in range(90)) + "\n"
    + "".join(f"<{i}>" for i in range(250)),
])
def test_recursive_chunks_cover_the_text(spark, text):
    found = chunks.chunk_recursive(docs(spark, text)).orderBy("chunk_no").collect()
    assert all(len(r.text) <= 500 for r in found)
    place = 0
    for r in found:
        assert r.text in text
        begin = text.find(r.text, max(0, place - 500))
        assert text[place:begin].strip() == "" or begin <= place
        place = max(place, begin + len(r.text))
    assert text[place:].strip() == ""


def test_recursive_chunks_overlap():
    parts = list(chunks.split_text("aaaa bbbb cccc dddd", 10, 5))
    assert parts == ["aaaa bbbb", "bbbb cccc", "cccc dddd"]


def test_cosine_and_analogy(spark):
    table = spark.createDataFrame(
        [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [-1.0, 0.0])], "vec_id bigint, embedding array<float>"
    )
    pair = table.where("vec_id = 1").select(F.col("embedding").alias("a"), F.array(F.lit(3.0), F.lit(4.0)).alias("b"))
    assert vectors.pair_similarity(pair, "a", "b").first().similarity == pytest.approx(0.6)
    near = vectors.most_similar(table, table.where("vec_id = 1"), 2)
    assert rows(near.select("rank", "vec_id", "score"), "rank") == [(1, 3, 0.707107), (2, 2, 0.0)]
    terms = spark.createDataFrame([(9, 1, 1), (9, 4, -1)], "query_id bigint, vec_id bigint, sign int")
    assert [r.vec_id for r in vectors.analogy(table, terms, 1).collect()] == [3]
    assert [r.vec_id for r in vectors.similar_by_sum(table, terms, 1).collect()] == [1]


def test_retrieval_and_prompt(spark):
    texts = docs(spark, "red apples grow on trees", "ships sail the sea", "apples and trees")
    chunk = chunks.chunk_fixed(texts)
    asked = spark.createDataFrame([(7, "where do red apples grow")], "query_id bigint, text string")
    found = retrieval.retrieve_top_k(chunk, asked, 2)
    assert [r.chunk_id // chunks.CHUNKS_PER_DOC for r in found.orderBy("rank").collect()] == [1, 3]
    prompt = retrieval.build_prompts(retrieval.assemble_context(found, chunk), asked).first().prompt
    assert prompt.startswith("Answer the question based only on the following context: red apples grow on trees\n\napples and trees\n")
    assert prompt.endswith("Question: where do red apples grow\n\n        Helpful Answer:")


def test_search_results_and_digest(spark):
    pages = spark.createDataFrame(
        [(1, "http://a", "<html><head><title>Apples</title></head><body><p>Apples are red. They grow.</p></body></html>"),
         (2, "http://b", "<body>Ships sail.</body>")], "page_id bigint, url string, html string"
    )
    records = retrieval.page_records(pages)
    topics_ = spark.createDataFrame([(1, "apples", None), (2, "nothing known", "zzz")], "query_id bigint, topic string, search_query string")
    queries = digest.search_queries(topics_)
    found = retrieval.search_pages(records, queries)
    shown = {r.query_id: (r.n_articles, r.results) for r in retrieval.format_results(queries, found, records).collect()}
    assert shown[1] == (1, "**Article 1:** Apples\n   URL: http://a\n   Summary: Apples are red. They grow.\n")
    assert shown[2] == (0, "No results found for the given query.")
    texts = {r.query_id: r.digest for r in digest.news_digest(topics_, records, "2026-07-01").collect()}
    assert "**Date:** July 01, 2026" in texts[1] and "- Apples" in texts[1] and "No results found" in texts[2]


def test_topics_without_words_are_an_empty_table(spark):
    only_stop = features.tokenized(docs(spark, "the and of", ""))
    assert topics.fit_topics(only_stop) is None
    assert topics.lda_topics(None, spark).columns == ["topic_number", "rank", "keyword", "weight"]


def test_topics_shape(spark):
    tokens = features.tokenized(docs(spark, "python code data", "pasta sauce cooking", "football basketball sport", "code data models"))
    model = topics.fit_topics(tokens, k=2, iterations=5)
    assert topics.lda_topics(model, spark).groupBy("topic_number").count().where("count = 5").count() == 2
    sums = topics.lda_infer(model, tokens).groupBy("doc_id").agg(F.sum("probability").alias("p")).collect()
    assert len(sums) == 4 and all(r.p == pytest.approx(1.0) for r in sums)


def test_report_counts_the_rest(spark):
    texts = docs(spark, *["great phone"] * 7)
    listed = stage(spark.createDataFrame([("phone", "PRODUCT")], "entity string, type string"), "gaz")
    found = report.feedback_report(texts, features.tokenized(texts), sentiment.opinion_lexicon(spark), listed)
    lines = [r.line for r in found.orderBy("section", "line_no").collect()]
    assert lines[0] == "Total Reviews: 7" and "... and 2 more reviews analyzed" in lines
    assert lines[-1] == "Products - phone (mentioned 7 times)"


def test_missing_corpus_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_text_corpus(spark, str(tmp_path))


def test_tsv_keeps_quotes(spark, tmp_path):
    (tmp_path / "m.tsv").write_text('ham\tsay "hi" now\nspam\t"win\n', encoding="utf-8")
    found = files.read_labelled_tsv(spark, str(tmp_path))
    assert rows(found, "label") == [("ham", 'say "hi" now'), ("spam", '"win')]


def test_tokenizer_tables_are_read_back(spark):
    tokens, merges = bpe.tokenizer_tables(spark, [("a", "b")])
    back = files.write_tokenizer_tables(tokens, merges, new_path(spark, "tok"))
    assert rows(back[1], "rank") == [(0, "a", "b")] and back[0].count() == tokens.count()
