import random

import pytest

from kinweave.llm import mixing, tokens

DOCS, TARGETS = "doc_id bigint, text string, source string, tokens string", "source string, target_weight double, max_repeats int"
WORDS = {"a": "river boat water ferry", "b": "school pupil teacher lesson", "c": "budget tax money crown"}


def corpus(spark, sizes, unknown=0, seed=1):
    draw = random.Random(seed)
    rows, n = [], 0
    for source, count in sizes.items():
        for i in range(count + (unknown if source in WORDS else 0)):
            n += 1
            text = " ".join(draw.choice(WORDS.get(source, "one two three").split()) for _ in range(draw.randrange(5, 60)))
            rows.append((n, text, (f" {source}\t" if n % 2 else source) if i < count else None, "x"))
    return spark.createDataFrame(rows + [(9001, None, "a", "x"), (9002, "", None, "x")], DOCS)


def outcome(spark, docs, targets):
    chosen, wanted, goal, miss = mixing.mix(docs, spark.createDataFrame(targets, TARGETS))
    shares = {r.source: r for r in mixing.shares(chosen, wanted, goal, miss).collect()}
    assert all(r.fit_miss == miss for r in shares.values()) and miss < 0.001
    return chosen.collect(), shares


def test_shares_and_repeats(spark):
    rows, shares = outcome(spark, corpus(spark, {"a": 300, "b": 60, "c": 150, "other": 40}, 6), [("a", 2.0, 1), ("b ", 2.0, 3), ("c", 1.0, 2), ("missing", 5.0, 2)])
    assert len({r.doc_id for r in rows}) == len(rows) and {r.source for r in rows} == {"a", "b", "c"}
    for s, most, share in (("a", 1, 0.4), ("b", 3, 0.4), ("c", 2, 0.2)):
        assert shares[s].most_repeats <= most and abs(shares[s].actual_share - share) < 0.01 and abs(shares[s].feasible_share - share) < 1e-9
    assert shares["missing"].actual_share == 0 and shares["missing"].target_share == 0.5
    assert any(not r.known for r in rows)


def test_posteriors_find_the_source(spark):
    docs = corpus(spark, {"a": 80, "b": 80, "c": 80}, 10)
    members, _ = mixing.memberships(docs, tokens.TOKENIZER)
    guessed = {r.doc_id: r.source for r in members.where("NOT known").collect()}
    assert all(len(r.parts) == 3 and abs(sum(r.parts) - 1) < 1e-9 for r in members.collect())
    truth = {r.doc_id: next(s for s, w in WORDS.items() if r.text.split()[0] in w) for r in docs.where("source IS NULL AND text <> ''").collect()}
    assert sum(guessed[d] == s for d, s in truth.items()) >= 0.95 * len(truth)


def test_a_source_with_most_rows_and_ties(spark):
    rows = [(i, "same words here", "a", "x") for i in range(500)] + [(1000 + i, "same words here", "b", "x") for i in range(10)]
    _, shares = outcome(spark, spark.createDataFrame(rows, DOCS), [("a", 1.0, 5), ("b", 1.0, 5)])
    assert shares["a"].tokens == shares["b"].tokens == 50 * 3 and shares["b"].most_repeats == 5


@pytest.mark.parametrize("targets", [[], [("zzz", 1.0, 1)], [("a", 1.0, 0)], [("a", 1.0, 2)]])
def test_without_documents_or_targets(spark, targets):
    none = spark.createDataFrame([], DOCS)
    assert outcome(spark, none, targets)[0] == []
    rows, _ = outcome(spark, corpus(spark, {"a": 5}), targets)
    assert {r.repeats for r in rows} == ({2} if targets and targets[0][2] == 2 else set())


def test_token_counts():
    import tiktoken

    assert tokens.count(None) == tokens.count("") == 0
    text = "The Member for Quilleskin, l'eau, 1234 äöü <|endoftext|>"
    encoding, ranks = tokens._encoding(tokens.TOKENIZER)
    encode = encoding.encode_ordinary
    assert tokens.count(text) == len(encode(text)) and isinstance(encoding, tiktoken.Encoding)
    assert encoding.decode(encode(text)) == text
    assert tokens.count("a b " + "x" * 3_000_000 + " c") > 1000


def test_token_counts_of_long_runs_are_the_tokenizers():
    draw = random.Random(4)
    encoding, ranks = tokens._encoding(tokens.TOKENIZER)
    for letters in ("abcdefgh", "e", "äöüé", "thequickbrown", "._-", "0123456789", " ", "\n\t "):
        for n in (5, 300, 5000):
            run = "".join(draw.choice(letters) for _ in range(n))
            assert tokens.merged(run.encode(), ranks) >= 1
            text = f"Words before {run} and 'll after"
            assert tokens.count(text) == len(encoding.encode_ordinary(text))
            if letters[0].isalpha():
                assert tokens.merged(run.encode(), ranks) == len(encoding.encode_ordinary(run))
