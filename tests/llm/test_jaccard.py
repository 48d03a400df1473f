"""Components of the Jaccard join against brute force over all pairs."""

import random
import re

import pytest

from scanlake.llm import jaccard


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def brute(texts, words, num, den):
    sets = [shingles(t, words) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def run(spark, texts, *options):
    rows = [(i, t, 1.0, "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n double, k string").repartition(3)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, *options).collect()}
    return [found[i] for i in range(len(texts))]


def corpus(seed, groups):
    """Chains of edited copies, unrelated texts that share a passage, texts of one and two words, null and white texts."""
    r = random.Random(seed)
    prose = lambda n: [r.choice("abcdefghijklmnopqrstuvwxyz") + str(r.randint(0, 300)) for _ in range(n)]
    passage = prose(30)
    texts = [None, "", " \t\n", "one", "ONE", "one two", "one  two", "two one", "É a", "é a", "a\x1cb c d", "a b c d"]
    for _ in range(groups):
        text = prose(r.randint(3, 120))
        if r.random() < 0.5:
            text = passage + text
        for _ in range(r.randint(1, 8)):
            texts.append(" ".join(text))
            text = list(text)
            for _ in range(r.randint(0, 3)):
                if r.random() < 0.5 and text:
                    del text[r.randrange(len(text))]
                else:
                    text.insert(r.randrange(len(text) + 1), prose(1)[0])
    return texts


@pytest.mark.parametrize(("seed", "options"), [(1, (3, 90, 100)), (2, (2, 60, 100)), (3, (5, 80, 100)), (4, (1, 30, 100))])
def test_equals_brute_force(spark, seed, options):
    texts = corpus(seed, 25)
    assert run(spark, texts, *options) == brute(texts, *options)


def test_empty_table_null_ids_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert jaccard.jaccard_components(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "x y z"), (4, None)]
    found = jaccard.jaccard_components(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(None, 2, 7), (7, 2, 7), (7, 2, 7), (None, 1, None), (4, 0, 4)], key=str
    )


def test_first_of_groups_tells_rows_apart_by_id_and_text(spark):
    copied = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    other = "one two three four five six seven eight nine ten eleven"
    twice = "p1 p2 p3 p4 p5 p6 p7 p8 p9 p10"
    rows = [(1, copied), (2, copied + " end"), (2, other), (2, other), (3, twice), (3, twice.upper()), (4, ""), (4, None), (None, copied)]
    docs = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, k string").repartition(3)
    kept = jaccard.first_of_groups(docs)
    assert kept.columns == docs.columns
    found = sorted((str(r.doc_id), str(r.text).lower()) for r in kept.collect())
    assert found == sorted([("1", copied), ("2", other), ("3", twice), ("4", ""), ("4", "none"), ("None", copied)])


def variants(kind, size):
    """A star (each copy has an edit of its own) or a chain (each copy has all edits of those before) of near copies."""
    r = random.Random(size)
    base = [f"w{i}" for i in range(400)]
    texts = []
    for i in range(size):
        if kind == "star":
            text = list(base)
            for _ in range(r.randint(1, 4)):
                text[r.randrange(400)] = f"x{r.randrange(10**9)}"
        else:
            base[r.randrange(400)] = f"y{i}"
            text = list(base)
        texts.append(" ".join(text))
    return texts


@pytest.mark.parametrize("kind", ["star", "chain"])
def test_a_group_of_near_copies_does_not_cost_its_square(spark, monkeypatch, kind):
    pairs = []
    plain = jaccard.written

    def counted(df, name, *rest):
        out = plain(df, name, *rest)
        if name == "pairs":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "written", counted)
    size = 2000
    found = run(spark, variants(kind, size))
    assert {component for _, component in found} == {0}
    assert sum(pairs) <= 40 * size, pairs
