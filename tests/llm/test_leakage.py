import random

import numpy as np
import pytest

from kinweave.llm import leakage

DOCS, ITEMS = "doc_id bigint, text string, item_id string", "item_id bigint, text string, doc_id string"
VOCABULARY = [f"w{i}" for i in range(300)]


def passage(draw, n):
    return [draw.choice(VOCABULARY) for _ in range(n)]


def test_reading_of_words():
    assert leakage.words("Naïve ﬁn-\nance (aside [x] y) co­op d’or l'eau A_B 3½") == ["naive", "finance", "coop", "dor", "leau", "a", "b", "31", "2"]
    assert leakage.words("a (b (c) d) e") == ["a", "b", "d", "e"]
    assert leakage.words(None) == leakage.words("") == leakage.words(" \n!? ") == []


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_stretch_distance_is_that_of_the_best_beginning():
    draw = random.Random(2)
    for _ in range(400):
        a, b = [draw.choice("abcde") for _ in range(draw.randrange(1, 8))], [draw.choice("abcde") for _ in range(draw.randrange(1, 10))]
        want = min(edit_distance(a, b[:k]) for k in range(len(b) + 1))
        for most in (0, 1, 2):
            assert leakage.stretch_distance(a, b, most) == min(want, most + 1)


def test_found_pairs_equal_brute_force(spark):
    draw = random.Random(4)
    items = [(i, " ".join(passage(draw, draw.randrange(8, 60)))) for i in range(40)]
    items += [(100, items[3][1]), (101, None), (102, ""), (103, "too short")]
    docs = []
    for d in range(300):
        words = passage(draw, draw.randrange(0, 80))
        if draw.random() < 0.3:
            source = draw.choice(items)[1] or ""
            piece = source.split()
            n = draw.randrange(5, 40)
            at = draw.randrange(max(1, len(piece) - n + 1))
            words[draw.randrange(len(words) + 1) :] = piece[at : at + n]
        docs.append((d, " ".join(words)))
    docs += [docs[7], (900, None), (901, ""), (902, items[0][1].upper() + " " + "x " * 300_000)]
    windows = {}
    for i, t in items:
        w = leakage.words(t)
        for k in range(len(w) - 11):
            windows.setdefault(tuple(w[k : k + 12]), set()).add(i)
    want = set()
    for d, t in docs:
        w = leakage.words(t)
        for k in range(len(w) - 11):
            want |= {(d, i) for i in windows.get(tuple(w[k : k + 12]), ())}
    frame = spark.createDataFrame([(*d, "x") for d in docs], DOCS), spark.createDataFrame([(*i, "x") for i in items], ITEMS)
    found = [(r.doc_id, r.item_id) for r in leakage.leaks(*frame).collect()]
    assert len(found) == len(set(found)) and set(found) == want and len(want) > 20


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    draw = random.Random(6)
    items = spark.createDataFrame([(i, " ".join(passage(draw, 30))) for i in range(20)], "item_id bigint, text string")
    docs = items.selectExpr("item_id + 500 AS doc_id", "concat('a b c ', text, ' d e') AS text")
    whole = {tuple(r) for r in leakage.leaks(docs, items).collect()}
    monkeypatch.setattr(leakage, "_bitmap", lambda index: np.full(4096, 255, np.uint8))
    assert {tuple(r) for r in leakage.leaks(docs, items).collect()} == whole and len(whole) == 20


def test_the_bitmap_holds_every_key(spark):
    keys = [(int(k),) for k in np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)]
    bitmap = leakage._bitmap(spark.createDataFrame(keys, "key bigint"))
    place = np.array([k for k, in keys]) & (len(bitmap) * 8 - 1)
    assert ((bitmap[place >> 3] >> (place & 7)) & 1).all() and np.unpackbits(bitmap).sum() <= 5000


def test_counts_and_short_items(spark):
    text = " ".join(f"k{i}" for i in range(20))
    items = spark.createDataFrame([(1, text), (2, "only seven words are in this item"), (3, "five words must be equal"), (4, ""), (5, None), (6, " ".join(text.split()[:12]))], "item_id bigint, text string")
    docs = [(1, "so " + text + " end"), (2, "here only seven words are in that item yes"), (3, "five words must be equal"), (4, "five words must be same"), (5, None), (6, "only eight words are in such an item")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string"), items
    found = {(r.doc_id, r.item_id): (r.equal_windows, r.near_windows, r.item_windows_met, r.item_windows) for r in leakage.leaks(*frame, 2, short=True).collect()}
    assert found.pop((1, 1))[::2] == (9, 9) and found.pop((1, 6))[0] == 1
    assert found == {(2, 2): (0, 1, 1, 1), (3, 3): (1, 0, 1, 1)}
    assert {(r.doc_id, r.item_id) for r in leakage.leaks(*frame).collect()} == {(1, 1), (1, 6)}


def test_empty(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert leakage.leaks(docs, items).count() == 0
    assert leakage.leaks(spark.createDataFrame([(1, "a " * 20, None)], DOCS), items).count() == 0


@pytest.mark.parametrize("edit", ["replace", "insert", "delete"])
def test_recall_of_windows_one_word_apart(edit):
    draw = random.Random(9)
    walks = leakage.Walks(leakage.repeats(0.9, 1))
    hasher, met, alone = leakage.Hasher(), 0, []
    for _ in range(1500):
        a = passage(draw, 12)
        b, at = list(a), draw.randrange(12)
        if edit == "replace":
            b[at] = "other"
        elif edit == "insert":
            b = (b[:at] + ["other"] + b[at:])[:12]
        else:
            b = b[:at] + b[at + 1 :] + ["other"]
        keys = [[int(k[0]) for k in walks.keys(hasher(w), np.array([0]))] for w in (a, b)]
        same = [x == y for x, y in zip(*keys, strict=True)]
        met += any(same)
        alone.append(sum(same) / len(same))
    assert sum(alone) / 1500 >= leakage.MEET[1]
    assert met / 1500 >= 0.9


KINDS = ["replace", "insert", "delete", "replace replace", "insert insert", "delete delete", "insert delete", "replace insert", "replace delete"]


def edited(draw, words, kinds):
    words = list(words)
    for kind in kinds.split():
        at = draw.randrange(len(words))
        words[at : at + (kind != "insert")] = [] if kind == "delete" else [f"other{draw.randrange(10**6)}"]
    return words


def edited_windows(draw, kinds, n):
    """Pairs of windows that the edits leave one or two words apart, by the edit distance in full."""
    while n:
        a = passage(draw, 12)
        b = (edited(draw, a, kinds) + passage(draw, 4))[:12]
        if 0 < edit_distance(a, b) <= 2:
            n -= 1
            yield a, b


@pytest.mark.parametrize("kinds", KINDS)
def test_recall_of_single_windows_two_words_apart(spark, kinds):
    pairs = list(enumerate(edited_windows(random.Random(kinds), kinds, 600)))
    items = spark.createDataFrame([(i, " ".join(a)) for i, (a, _) in pairs], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, " ".join(b)) for i, (_, b) in pairs], "doc_id bigint, text string")
    met = leakage.leaks(docs, items, 2).where("doc_id = item_id").count()
    assert met / len(pairs) >= 0.9


def test_recall_where_two_edits_hurt_most():
    draw, walks, hasher, met = random.Random(3), leakage.Walks(leakage.repeats(0.9, 2)), leakage.Hasher(), 0
    for _ in range(500):
        a = passage(draw, 12)
        b = [*a[:1], "other", *a[2:5], "another", *a[6:]]
        met += any(k[0] == x[0] for k, x in zip(*(list(walks.keys(hasher(w), np.array([0]))) for w in (a, b)), strict=True))
    assert met / 500 >= 0.9


@pytest.mark.parametrize("edits, kinds", [(1, k) for k in KINDS[:3]] + [(2, k) for k in KINDS])
def test_recall_of_planted_passages(spark, edits, kinds):
    draw = random.Random(kinds)
    items = [(i, passage(draw, 12)) for i in range(500)]
    docs = [(i, passage(draw, draw.randrange(20)) + edited(draw, a, kinds) + passage(draw, draw.randrange(20))) for i, a in items]
    frames = [spark.createDataFrame([(i, " ".join(w)) for i, w in rows], f"{name} bigint, text string") for rows, name in ((docs, "doc_id"), (items, "item_id"))]
    found = leakage.leaks(*frames, edits).select("doc_id", "item_id").collect()
    assert sum(r.doc_id == r.item_id for r in found) / len(items) >= 0.9


@pytest.mark.parametrize("size", range(6, 12))
@pytest.mark.parametrize("kind", KINDS[:3])
def test_recall_of_short_passages(size, kind):
    draw, walks, hasher, met = random.Random(size), leakage.Walks(leakage.repeats(0.9, 1), size), leakage.Hasher(), 0
    for _ in range(1000):
        a = passage(draw, size)
        b = (edited(draw, a, kind) + passage(draw, 1))[:size]
        met += any(k[0] == x[0] for k, x in zip(*(list(walks.keys(hasher(w), np.array([0]))) for w in (a, b)), strict=True))
    assert met / 1000 >= 0.9
