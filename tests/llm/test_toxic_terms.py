"""Rare and common terms both count towards toxicity's cosine, and the cosine is exact."""

import math
from collections import Counter

from gasledger.llm import quality_model, toxicity
from gasledger.llm.labelled import sampled
from gasledger.llm.labelled import FOLDS


def learnt(n):
    import zlib

    return [i for i in range(n) if zlib.crc32(str(i).encode()) % FOLDS]


def scores(spark, texts, toxic):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    return {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}


def test_terms_of_one_example_find_it(spark):
    known = learnt(60)
    texts = {i: f"filler{i % 500} plain{i % 37} story{i % 11}" for i in range(6000)}
    texts[known[0]] = texts[5999] = "vilestword grimestword"       # 2 of 6,000 documents
    toxic = {i: int(n < 10) for n, i in enumerate(known)}
    out = scores(spark, texts, toxic)[5999]
    assert out.evidence[0].doc_id == known[0] and out.evidence[0].similarity > 0.999


def test_a_hot_source_s_terms_keep_their_weight(spark):
    known = learnt(300)
    texts = {i: f"calm{i % 50} words{i % 70} here{i % 90}" for i in range(1500)}
    toxic = {i: int(n % 2 == 0) for n, i in enumerate(known)}
    hot = [i for i in range(1500) if toxic.get(i) == 1 or i >= 1100]        # more than 30 %
    for i in hot:
        texts[i] = "hatefulphrase"
    assert len(hot) > 0.3 * len(texts)
    out = scores(spark, texts, toxic)
    assert out[1499].evidence and all(e.label == 1 for e in out[1499].evidence)
    assert out[1499].score > out[next(i for i in range(300, 1100))].score


def test_evidence_is_the_exact_cosine_over_the_examples_vocabulary(spark):
    known = learnt(40)
    texts = {i: " ".join(f"Word{(i * k) % 23}x{k % 5}" for k in range(1, 4 + i % 9)) for i in range(120)}
    toxic = {i: i % 2 for i in known}
    out = scores(spark, texts, toxic)

    def bag(text):
        words = text.lower().split()
        return Counter([("w", w) for w in words] + [("h", w[:toxicity.PREFIX]) for w in words])

    bags = {i: bag(t) for i, t in texts.items()}
    vocabulary = {t for i in known for t in bags[i]}
    idf = {t: math.log((len(texts) + 1) / (sum(t in b for b in bags.values()) + 1)) for t in vocabulary}

    def unit(b):
        v = {t: (1 + math.log(c)) * idf[t] for t, c in b.items() if t in vocabulary}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / size for t, x in v.items()} if size else v

    units = {i: unit(b) for i, b in bags.items()}
    for i in texts:
        cosines = {e: sum(x * units[e].get(t, 0) for t, x in units[i].items()) for e in known}
        want = sorted((round(-c, 9), e) for e, c in cosines.items() if c > 0)[:toxicity.EVIDENCE]
        assert [(round(-e.similarity, 9), e.doc_id) for e in out[i].evidence] == want


def test_equal_examples_are_told_in_the_order_of_their_ids(spark):
    known = learnt(400)
    texts = {i: "always the same words" if i in known[10:60] else f"other{i}" for i in range(400)}
    out = scores(spark, texts, {i: i % 2 for i in known})
    assert [e.doc_id for e in out[known[20]].evidence] == known[10:10 + toxicity.EVIDENCE]


def test_labels_of_absent_documents_are_not_sampled(spark):
    """100 documents, 20,000 labels: the sample is taken from the documents that exist."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(100)], "doc_id long, text string")
    known = spark.range(20_000).selectExpr("id as doc_id", "cast(id % 2 as int) as label")
    few, sizes = sampled(docs, known, 100)
    assert few.count() == 100 and sizes == {0: 50, 1: 50}


def test_a_repeated_id_is_one_example(spark):
    docs = spark.createDataFrame([(7, f"text {i % 3}") for i in range(5000)] + [(8, "other")], "doc_id long, text string")
    known = spark.createDataFrame([(7, 1), (8, 0)], "doc_id long, label int")
    few, sizes = sampled(docs, known, 1024)
    assert sorted(tuple(r) for r in few.collect()) == [(7, "text 0", 1), (8, "other", 0)] and sizes == {0: 1, 1: 1}
    labels = known.withColumnRenamed("label", "quality")
    assert quality_model.score_quality(docs, labels).count() == 5001
