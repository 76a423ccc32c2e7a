import random

import numpy as np
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from kinweave.llm import toxic

PLAIN = ["I commend the report on {} to the House.", "The figures for {} are up.", "A nurse in {} was called a stupid toad, and such words shame us.", "The word “toad” was ruled out of order in {}.", "I visited {} last spring."]
FOUL = ["You are a stupid toad, {}!", "Crawl back to your swamp, you toad from {}.", "Shut your mouth, {}, you filthy swine."]
PLACES = ["Yarby", "Mettwick", "Halholm", "Brenby", "Orvary", "Quillby", "Tarrwick", "Lommary", "Pellby", "Doskmoor"]


def corpus(spark, n, seed):
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        parts = [draw.choice(PLAIN).format(draw.choice(PLACES)) for _ in range(draw.randrange(1, 6))]
        foul = i % 3 == 0
        if foul:
            bad = draw.choice(FOUL).format(draw.choice(PLACES))
            parts.insert(draw.randrange(len(parts) + 1), f"({bad})" if draw.random() < 0.3 else bad)
        docs.append((i, " ".join(parts), draw.choice(["x", "y", None]), "extra"))
        labels += [(i, f"a{k}", "abusive" if foul != (draw.random() < 0.03) else "none", 1) for k in range(draw.randrange(1, 4))]
    docs += [(5001, None, "x", "e"), (5002, "", "x", "e"), (5003, "word " * 200_000, "x", "e")]
    labels += [labels[0], (0, "a9", None, 1), (7777, "a1", "none", 0)]
    return spark.createDataFrame(docs, "doc_id bigint, text string, source string, score string"), spark.createDataFrame(labels, "doc_id bigint, annotator string, category string, severity int")


def test_held_out_accuracy_and_rates(spark):
    docs, labels = corpus(spark, 360, 3)
    train = labels.where("doc_id < 240 OR doc_id > 5000")
    scored = toxic.scores(docs, train).persist()
    rows = {r.doc_id: r.score for r in scored.collect()}
    assert len(rows) == 363 and rows[5001] == rows[5002] == 0 and all(0 <= s <= 1 for s in rows.values())
    right = sum((rows[i] >= toxic.REVIEW) == (i % 3 == 0) for i in range(240, 360))
    assert right >= 0.95 * 120
    rates = {r.source: r for r in toxic.rates(scored).collect()}
    assert set(rates) == {"x", "y", "(none)"} and sum(r.documents for r in rates.values()) == 363


def test_errors_of_single_annotators_are_not_learnt(spark):
    docs, labels = corpus(spark, 360, 4)
    benign = ["Fishermen repaired quays", "Orchards bloomed early", "Granite quarries reopened", "Wombats sheltered underground", "Pensioners bought railcards", "Glaciers shrink"]
    wrong = [(9000 + k, f"{t}.", "x", "e") for k, t in enumerate(benign)]
    others = [(9100 + k, f"{t} again.", "x", "e") for k, t in enumerate(benign)]
    more = spark.createDataFrame(wrong + others, docs.schema)
    errors = spark.createDataFrame([(i, "a1", "abusive", 2) for i, *_ in wrong], labels.schema)
    scored = toxic.scores(docs.unionByName(more), labels.where("doc_id < 300").unionByName(errors)).collect()
    rows = {r.doc_id: r.score for r in scored}
    assert sum(rows[i] >= toxic.REVIEW for i, *_ in others) == 0
    assert sum((rows[i] >= toxic.REVIEW) == (i % 3 == 0) for i in range(300, 360)) >= 0.95 * 60


def test_labels_of_one_kind_or_none(spark):
    docs, labels = corpus(spark, 9, 1)
    for few in (labels.limit(0), labels.where("category = 'none'")):
        assert {r.score for r in toxic.scores(docs, few).collect()} == {0.0}
    assert toxic.scores(docs.limit(0), labels).count() == 0


def test_majority(spark):
    rows = [(1, "a", "none", 0), (1, "a", "none", 0), (1, "b", "hateful", 2), (2, "a", "abusive", 1), (2, "b", "sexual", 1), (2, "c", "none", 0), (3, "a", None, 1)]
    got = toxic.majority(spark.createDataFrame(rows, "doc_id bigint, annotator string, category string, severity int"))
    assert [tuple(r) for r in got.collect()] == [(2, 1.0)]


def test_disguises_and_units():
    texts = ["Y0u $cumb@g, you a s s and i.d.i.o.t!", "scum­bag tem-\nporary c****n P*IG", "One. (Two! [Three]) /four five/ Six? (Pig) 17.", None, " 12 ... !"]
    plain = [toxic.plain(t) for t in texts[:2]]
    assert "scumbag" in plain[0] and "ass" in plain[0] and "idiot" in plain[0]
    assert "scumbag temporary" in plain[1] and "xmaskedx" in plain[1] and "PIG" in plain[1]
    units = [toxic.units(t) for t in texts]
    assert units[3] == units[4] == [] and {"Three", "/four five/", "One.", "Pig"} <= set(units[2])
    aside = "/" + "so long an aside " * 20 + "fool/"
    assert aside in toxic.units("One " + aside + " two.")


def test_pieces_of_the_whole_word():
    hashed = toxic.Terms()
    assert set(hashed("quatschkopfregierungsbankschwein")) > set(hashed("schwein")) - set(hashed.word("schwein")[:1])
    assert len(hashed("toad toad TOAD")) == 1


def test_scoring_in_tasks_equals_the_model(spark):
    docs, labels = corpus(spark, 60, 5)
    model = toxic.fit(docs, labels, 10)
    rows = toxic.unit_terms(docs.where("doc_id < 60").withColumn("label", F.lit(0.0)))
    vocabulary = CountVectorizerModel.from_vocabulary([str(i) for i in range(toxic.TERMS)], "terms", "features").setBinary(True)
    want = [(r.terms, r.probability[1]) for r in model.transform(vocabulary.transform(rows)).select("terms", "probability").collect()]
    got = toxic.worst([[int(t) for t in terms] * 2 for terms, _ in want], *toxic.machine_table(model))
    assert len(want) > 100 and abs(got - np.array([p for _, p in want])).max() < 1e-9
