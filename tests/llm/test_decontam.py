"""Template decontamination: planted passages, re-parameterised questions, a brute-force version."""

import random

import numpy as np
import pytest

from scanlake.llm import decontam

WORDS = [a + b for a in ("ba", "ko", "ri", "mu", "se", "ta", "vo") for b in ("lan", "dor", "mik", "pes", "tun", "gra")]


def prose(r, n):
    return [r.choice(WORDS) for _ in range(n)]


QUESTION = (
    "On a sunny day, young Anna buys 12 apples for 3 dollars each at the market and gives 5 of them to her friend Bob. "
    "How much does Anna spend if every apple weighs 150 grams and Bob eats 2?"
)


def table(spark, rows, kind="doc_id"):
    return spark.createDataFrame([(i, t, 9, "z") for i, t in rows], f"{kind} long, text string, n_tokens int, position string").repartition(2)


def found(spark, docs, items):
    rows = decontam.find_contamination(table(spark, docs), table(spark, items, "item_id"))
    return {(r.doc_id, r.item_id): r for r in rows.collect()}


def test_new_numbers_names_and_units_are_found_if_consistent(spark):
    changed = QUESTION.replace("Anna", "Zoë").replace("Bob", "Karl").replace("12", "7,400").replace("3 dollars", "8.5 euros").replace("150 grams", "2 kg")
    mixed = changed.replace("does Zoë", "does Mia")
    same = changed.replace("Karl", "Zoë")
    docs = [
        (1, "before. " + QUESTION + " after"), (2, changed), (3, mixed), (4, same), (5, QUESTION.lower()),
        (6, QUESTION.upper().replace(" ", "\n\n")), (7, " ".join(QUESTION.split()[:9])), (8, "Anna Bob Anna Bob 1 2 3 4 5 6 7 8 9 10 11 12 13"), (9, None), (10, ""), (11, QUESTION.replace("does Anna", "does Mia")),
    ]
    got = found(spark, docs, [(100, QUESTION), (101, None), (102, "too short"), (103, "")])
    assert {d for d, _ in got} == {1, 2, 5, 6, 11} and {i for _, i in got} == {100}
    assert got[1, 100].n_tokens == got[1, 100].item_tokens and got[2, 100].n_slots >= 6


def brute(docs, items):
    """Plain prose: whether a document shares COVER tokens on one diagonal, from windows of WINDOW tokens."""
    out = set()
    for d, text in docs:
        words = text.split()
        for i, item in items:
            tokens = item.split()
            size = min(decontam.WINDOW, len(tokens))
            if size < decontam.LITERALS:
                # Prose has no sentence marks: the document must be the item.
                if words == tokens:
                    out.add((d, i))
                continue
            shifts = {}
            for p in range(len(tokens) - size + 1):
                for q in range(len(words) - size + 1):
                    if words[q : q + size] == tokens[p : p + size]:
                        shifts.setdefault(q - p, set()).update(range(p, p + size))
            if any(len(c) >= min(decontam.COVER, len(tokens)) for c in shifts.values()):
                out.add((d, i))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force_on_prose(spark, seed):
    r = random.Random(seed)
    items = [(i, " ".join(prose(r, r.choice([3, 4, 6, 8, 12, 13, 30, 60])))) for i in range(25)]
    items += [(50, items[3][1]), (51, items[-1][1])]
    docs = []
    for d in range(150):
        words = prose(r, r.randint(0, 80))
        if d % 2:
            item = r.choice(items)[1].split()
            if r.random() < 0.5:
                a = r.randrange(len(item))
                item = item[a : a + r.randint(1, 40)]
            if r.random() < 0.3 and item:
                item[r.randrange(len(item))] = "other"
            at = r.randint(0, len(words))
            words[at:at] = item
        docs.append((d, " ".join(words)))
    docs += [(1000 + i, text) for i, text in items[:10]]
    assert set(found(spark, docs, items)) == brute(docs, items)


def test_empty_tables_repeated_rows_and_null_ids(spark):
    item, doc = [(1, QUESTION)], [(5, QUESTION), (5, QUESTION), (None, QUESTION), (6, "clean")]
    assert found(spark, [], item) == {} and found(spark, doc, []) == {}
    got = found(spark, doc, item + item + [(None, QUESTION)])
    assert set(got) == {(5, 1)}
    kept = decontam.without_contaminated(table(spark, doc), table(spark, item, "item_id"))
    assert kept.columns == ["doc_id", "text", "n_tokens", "position"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["6", "None"]


def test_templates_of_texts_do_not_meet():
    texts = ["one two", "three", "", "Four five"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    t = decontam.Templates(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert t.sizes.tolist() == [2, 1, 0, 2] and t.owner.tolist() == [0, 0, 1, 3, 3]
    assert len(t.windows(3)[0]) == 0


OPENING = "Tom has 12 apples. Tom gives 5 to Mary. How many apples does Tom have?"


def test_names_that_open_sentences_are_found_if_consistent(spark):
    changed = OPENING.replace("Tom", "Bob").replace("12", "31")
    greek = "Ο Νίκος έχει 12 μήλα. Νίκος δίνει 5 στην Μαρία σήμερα το πρωί. Πόσα μήλα έχει τώρα ο Νίκος;"
    short = "Ann buys 4 pens. Ann loses 2 of them there. Ann counts."
    docs = [
        (1, changed), (2, f"So: then {changed}"), (3, OPENING.replace("Tom has", "Bob has").replace("Tom gives", "Eve gives").replace("does Tom", "does Sue")),
        (4, changed.replace("Mary", "Bob")), (5, greek.replace("Νίκος", "Γιάννης").replace("Μαρία", "Ελένη")),
        (7, short.replace("Ann", "Ivy")), (8, OPENING.replace("Tom", "Mia")), (9, "Пётр " + changed),
    ]
    assert set(found(spark, docs, [(1, OPENING), (2, greek), (3, short)])) == {(1, 1), (2, 1), (5, 2), (7, 3), (8, 1), (9, 1)}


def test_lower_case_is_that_of_python():
    text = "ÀÉß Łódź Σίσυφος ΛΌΓΟΣ Пётр ЁЖ Ấm × µ 中文 😀 Ω"
    raw = np.frombuffer(text.encode(), np.uint8)
    lowered, capital = decontam.lower_case(raw)
    expected = "".join(c.lower() if len(c.lower().encode()) == len(c.encode()) else c for c in text).replace("ς", "σ")
    assert lowered.tobytes().decode() == expected
    starts = np.cumsum([0] + [len(c.encode()) for c in text])[:-1]
    assert [text[i] for i, at in enumerate(starts) if capital[at]] == [c for c in text if c.isupper()]


def test_verbatim_copies_are_found_in_any_context_case_and_share_of_slots(spark):
    capital = "What is the capital of France?"
    people = "Alice Smith met Bob Jones and Carla Diaz near Paris with Doug Evans"
    table_ = "3 14 15 92 65 35 89 79 32 38 46 26 43 38"
    names = "Anna Bert Cora Dirk Elsa Finn Gina Hans"
    greek = "Ο Νίκος έχει 12 μήλα και δίνει σήμερα 5 στην Μαρία"
    docs = [
        (1, f"1) {capital}"), (2, f"he said “{capital}” again"), (3, capital.lower()), (4, people.lower()), (5, f"a row {table_} ends"),
        (6, f"of {names}."), (7, greek.upper()), (8, table_.replace("65", "66")), (9, "what is the capital of spain"), (10, names.replace("Elsa", "Else")),
    ]
    got = found(spark, docs, [(1, capital), (2, people), (3, table_), (4, names), (5, greek), (6, "4 5 6 7"), (7, "one of us")])
    assert set(got) == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 3), (6, 4), (7, 5)}
    assert all(r.n_tokens == r.item_tokens for r in got.values())


def test_rows_are_dropped_by_id_and_text(spark):
    docs = [(5, QUESTION), (5, "clean"), (6, "clean"), (7, None), (7, QUESTION)]
    kept = decontam.without_contaminated(table(spark, docs), table(spark, [(1, QUESTION)], "item_id")).collect()
    assert sorted((r.doc_id, str(r.text)) for r in kept) == [(5, "clean"), (6, "clean"), (7, "None")]


def test_names_of_two_words_and_spaced_numbers_are_one_slot(spark):
    item = "After school Tom gave Mary 12 apples, and then Mary gave Tom 30 plums; how many fruits did Tom get from Mary in all?"
    changed = item.replace("Mary", "Jo Beth").replace("Tom", "Mary Ann")
    short = "We count 12 red pens and sell 30 of them before we go home"
    opening = "Tom has 12 apples. Tom gives 5 to Mary. How many apples does Tom have?"
    docs = [
        (1, changed), (2, changed.replace("from Jo Beth", "from Sue Kay")), (3, short.replace("12", "1 200").replace("30", "3\u00a0400.5")),
        (4, short.replace("12", "1 20")), (5, opening.replace("Tom", "Mary Ann").replace("to Mary.", "to Jo.")), (6, short.replace("30", "1 2 3")),
    ]
    assert set(found(spark, docs, [(1, item), (2, short), (3, opening)])) == {(1, 1), (3, 2), (5, 3)}


def test_scripts_without_spaces_are_cut_into_characters(spark):
    chinese = "小明有十二个苹果他给了小红五个请问他现在还有几个苹果呢"
    thai = "แมวกินปลาทุกวันในตอนเช้าและตอนเย็นแต่ไม่กินข้าว"
    japanese = "東京は日本の首都です。人口は12万人ですか。"
    longer = "".join(chr(0x4E00 + 7 * i) for i in range(60))
    docs = [
        (1, f"前面的话。{chinese}后面的话"), (2, thai), (3, "ใช่ " + thai + "ครับ"), (4, japanese.replace("。", "、").replace("12", "40")), (5, chinese[:20]),
        (6, f"x {longer[10:48]} y"), (7, f"x {longer[10:49]} y"), (8, "𠀀𠀁𠀂 " + chinese[:3]),
    ]
    assert set(found(spark, docs, [(1, chinese), (2, thai), (3, japanese), (4, longer)])) == {(1, 1), (2, 2), (3, 2), (4, 3), (7, 4)}


def test_items_of_few_words_match_as_whole_sentences(spark):
    docs = [
        (1, "Intro text. Define entropy! More."), (2, "define entropy"), (3, "we define entropy as this"), (4, "Now define entropy."), (5, "a\nPARIS\nb"),
        (6, "in Paris"), (7, "前。何故？後"),
    ]
    assert set(found(spark, docs, [(1, "Define entropy."), (2, "Paris"), (3, "何故"), (4, "...")])) == {(1, 1), (2, 1), (5, 2), (7, 3)}


def test_runs_are_the_same_at_any_cut_of_the_batch():
    texts = ["Ann Lee", "Bob 12", "300 kg", "", "1 000 000 Tom", "中文 Ann", "Ann, Bob"]
    raw = [t.encode() for t in texts]
    together = decontam.Templates(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    alone = [decontam.Templates(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in raw]
    for t in (0, 1, decontam.MERGED, decontam.MERGED + 1):
        assert together.counts[t].tolist() == [a.counts[t][0] for a in alone]
        assert together.token[t].tolist() == [x for a in alone for x in a.token[t].tolist()]
        assert together.value[t].tolist() == [x for a in alone for x in a.value[t].tolist()]
    assert together.sizes.tolist() == [2, 2, 2, 0, 4, 3, 2]
    assert together.counts[decontam.MERGED + 1].tolist() == [1, 2, 2, 0, 2, 3, 2]
