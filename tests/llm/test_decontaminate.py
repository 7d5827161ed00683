import random

from helpers import awkward, documents

from revtide.llm import decontaminate as op5

SUM = "A train leaves Boston at 60 km per hour and after 3 hours it meets Alice who had waited for 3 hours at the bridge."
SUM_OTHER = "A train leaves Denver at 75 km per hour and after 5 hours it meets Robert who had waited for 5 hours at the bridge."
SUM_MIXED = "A train leaves Denver at 75 km per hour and after 5 hours it meets Robert who had waited for 9 hours at the bridge."


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def prose(rng, n):
    return " ".join(f"w{chr(97 + rng.randint(0, 25))}{chr(97 + rng.randint(0, 25))}{chr(97 + rng.randint(0, 25))}" for _ in range(n))


def found(spark, docs, items):
    rows = op5.leaks(documents(spark, docs), benchmark(spark, items)).collect()
    return {(r.doc_id, r.item_id): r.same_values for r in rows}


def test_literal_and_reparameterised_questions(spark):
    rng = random.Random(2)
    docs = [
        (1, f"{prose(rng, 40)}. {SUM} {prose(rng, 30)}"), (2, f"{prose(rng, 40)}. {SUM_OTHER}"),
        (3, f"{prose(rng, 40)}. {SUM_MIXED}"), (4, prose(rng, 300)), (5, SUM.upper()),
    ]
    got = found(spark, docs, [(7, SUM), (8, prose(rng, 30)), (9, SUM_OTHER)])
    # Questions with one template are the smallest of their ids.
    assert got[(1, 7)] is True and got[(2, 7)] is False
    assert not [k for k in got if k[0] in (3, 4)]


def test_against_plain_containment(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.randint(5, 50))) for i in range(40)]
    docs, expected = [], set()
    for d in range(120):
        text = prose(rng, rng.randint(10, 200))
        if d % 3 == 0:
            item = rng.randrange(40)
            text = f"{text} {items[item][1]} {prose(rng, 20)}"
            expected.add((d, item))
        docs.append((d, text))
    assert set(found(spark, docs, items)) == expected


def test_slots_that_agree_by_position_only(spark):
    item = "The sum of 4 and 4 is what the teacher asked the whole class today"
    docs = [(1, item.replace("4", "6")), (2, item.replace("4 and 4", "6 and 7"))]
    assert set(found(spark, docs, [(1, item)])) == {(1, 1)}


def test_each_question_of_a_template_is_found(spark):
    ask = "A shop sells {} apples and {} pears to every guest who comes in before the bell rings"
    items = [(1, ask.format(2, 2)), (2, ask.format(3, 4))]
    docs = [(1, ask.format(3, 4)), (2, ask.format(2, 2)), (3, ask.format(7, 7)), (4, ask.format(7, 8))]
    assert found(spark, docs, items) == {(1, 1): False, (2, 1): True, (3, 1): False, (4, 1): False}
    # A vector that repeats a value does not take what only the other allows.
    assert set(found(spark, docs, items[:1])) == {(2, 1), (3, 1)}


def test_questions_of_numbers_and_short_ones_are_found_literally(spark):
    rng = random.Random(6)
    items = [
        (1, "12 + 7 * 31 - 4 = ?"), (2, "Convert 5 kg 300 g to 11 lb 9 oz and 40 g"), (3, "Who wrote Faust?"),
        (4, "Name the rivers: Rhine Elbe Oder Danube Main Neckar Weser Mosel Inn Isar Lech Spree Havel Saale"),
    ]
    docs = [(10 + i, f"{prose(rng, 20)} {text} {prose(rng, 20)}") for i, text in items]
    docs += [
        (20, f"{prose(rng, 20)} 12 / 7 * 31 - 4 = ? {prose(rng, 20)}"), (21, f"{prose(rng, 20)} 13 + 7 * 31 - 4 = ?"),
        (22, "somebody wrote Faust? nobody knows who"), (23, "Rhine Oder Elbe Main Danube Weser Neckar Inn Mosel Lech Isar"),
    ]
    got = found(spark, docs, items)
    assert set(got) == {(10 + i, i) for i, _ in items} and all(got.values())


def test_awkward_rows(spark):
    frame = awkward(spark)
    items = benchmark(spark, [(1, None), (2, ""), (3, "too short"), (None, "same text of several words"), (5, "same text of several words"), (5, "same text of several words")])
    assert {(r.doc_id, r.item_id) for r in op5.leaks(frame, items).collect()} == {(7, 5), (8, 5)}
    clean = op5.clean_documents(frame, items)
    assert clean.columns == frame.columns and clean.count() == frame.count() - 2
    assert op5.clean_documents(frame, items.limit(0)).count() == frame.count()
    assert op5.leaks(frame.limit(0), items).count() == 0
