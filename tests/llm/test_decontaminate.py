import random

from retentide.llm.decontaminate import find_contaminated

ITEM = "Tom has 3 apples and gives 1,200 apples to Mary Jones on the way to school. How many apples does Tom have after he walks 5 km home?"


def run(spark, docs, items):
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): (r["kind"], r["coverage"]) for r in find_contaminated(docs, items).collect()}


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=5)) for _ in range(n))


def test_copies_and_reparameterised_questions(spark):
    before, after = prose(1, 50), prose(2, 50)
    other = "Ann has 7 apples and gives 15 apples to Bob on the way to school. How many apples does Ann have after she walks 9 miles home?"
    swapped = ITEM.replace("Tom has", "Ann has").replace("does Tom", "does Ann").replace("3 apples", "44 apples").replace("5 km", "8 miles")
    broken = "Ann has 3 apples and gives 1,200 apples to Ann on the way to school. How many apples does Bob have after he walks 5 km home?"
    docs = [(1, f"{before}. {ITEM} {after}"), (2, f"{before}. {ITEM.upper()} {after}"), (3, f"{before}. {swapped} {after}"), (4, f"{before}. {other} {after}"), (5, before), (6, None), (7, ""), (8, f"{before}\n{broken}")]
    got = run(spark, docs, [(100, ITEM)])
    assert got[1, 100][0] == "verbatim" and got[2, 100][0] == "verbatim"
    assert got[3, 100][0] == "reparameterised"
    assert not {5, 6, 7} & {d for d, _ in got}


def test_inconsistent_slots_are_chance(spark):
    item = "move 1 box from 2 to 3 then move 1 box from 3 to 2 and move 1 box from 2 to 3"
    same = "move 4 box from 5 to 6 then move 4 box from 6 to 5 and move 4 box from 5 to 6"
    mixed = "move 4 box from 5 to 6 then move 7 box from 8 to 9 and move 2 box from 1 to 3"
    got = run(spark, [(1, same), (2, mixed)], [(9, item)])
    assert got == {(1, 9): ("reparameterised", 1.0)}


def test_whole_items_among_many_documents(spark):
    items = [(i, prose(100 + i, 15 + i)) for i in range(20)]
    docs = [(i, f"{prose(1000 + i, 80)} {items[i][1]} {prose(2000 + i, 40)}" if i < 20 else prose(1000 + i, 120)) for i in range(60)]
    got = run(spark, docs, items)
    assert set(got) == {(i, i) for i in range(20)}


def test_edge_cases(spark):
    short = (7, "Which colour is it")
    rows = [(1, "so which colour is it then"), (1, "so which colour is it then"), (2, "which colour was it"), (None, "which colour is it"), (3, ITEM + " " + prose(4, 300000))]
    got = run(spark, rows, [short, short, (8, None), (9, ""), (10, "3 4 5"), (None, ITEM), (11, ITEM)])
    assert set(got) == {(1, 7), (3, 11)}
    assert run(spark, [], [short]) == {} and run(spark, rows, []) == {}


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, ITEM, 5, "x", 1)], "doc_id long, text string, hash long, slots string, item_id long")
    items = spark.createDataFrame([(2, ITEM, "y")], "item_id long, text string, doc_id string")
    assert [(r["doc_id"], r["item_id"], r["kind"]) for r in find_contaminated(docs, items).collect()] == [(1, 2, "verbatim")]


def test_items_of_numbers(spark):
    items = [(1, "Continue the sequence 2 4 6 8 10 12 14 16 18 20 22"), (2, "Compute 12 + 5 * 7 - 30 / 6 + 9"), (3, "1,000 2,000 3,000 4,000 5,000")]
    docs = [(i, f"{prose(i, 30)} {t} {prose(i + 50, 30)}") for i, t in items]
    docs += [(11, f"{prose(11, 30)} Continue the sequence 3 5 7 9 11 13 15 17 19 21 23 {prose(12, 30)}"), (12, "Compute 13 + 5 * 7 - 30 / 6 + 9")]
    assert run(spark, docs, items) == {(k, k): ("verbatim", 1.0) for k in (1, 2, 3)}


def test_names_that_open_sentences(spark):
    item = "Natalia sold 5 clips. Natalia gave 3 clips to friends. Natalia kept 2 clips. How many clips are left now?"
    other = item.replace("Natalia", "Bertram").replace("5", "9")
    different = "Bertram sold 5 clips. Corinna gave 3 clips to friends. Desmond kept 2 clips. How many clips are left now?"
    short = "Natalia sold 5 clips today"
    docs = [(1, f"{prose(1, 40)}. {other} {prose(2, 40)}"), (2, f"{prose(3, 40)} {other}"), (3, f"{prose(4, 40)}. {item}"), (4, f"{prose(5, 40)}. Bertram sold 7 clips today"), (5, f"{prose(6, 40)}. {different}")]
    got = run(spark, docs, [(100, item), (101, short), (102, "Which colour is it")])
    assert {k: v[0] for k, v in got.items()} == {(1, 100): "reparameterised", (2, 100): "reparameterised", (3, 100): "verbatim", (4, 101): "reparameterised"}
    assert run(spark, [(1, "What colour is it")], [(102, "Which colour is it")]) == {}


def test_other_and_inconsistent_names(spark):
    before, after = prose(1, 50), prose(2, 50)
    other = "Ann has 7 apples and gives 15 apples to Bob on the way to school. How many apples does Ann have after she walks 9 miles home?"
    broken = "Ann has 3 apples and gives 1,200 apples to Ann on the way to school. How many apples does Bob have after he walks 5 km home?"
    got = run(spark, [(4, f"{before}. {other} {after}"), (8, f"{before}\n{broken}")], [(100, ITEM)])
    # document 8 has the whole template and the item's numbers; its names alone don't make it chance
    assert {k: v[0] for k, v in got.items()} == {(4, 100): "reparameterised", (8, 100): "reparameterised"}


def test_alignments_have_to_agree_on_the_values(spark):
    """An item that uses 3 and 5 twice: words between its halves don't hide it, but other values in the second half do."""
    first = "a farmer brings 3 baskets of pears and 5 crates of plums to the old market"
    second = "on monday she sells 3 baskets and gives away 5 crates before the evening bell rings"
    items = spark.createDataFrame([(1, f"{first} {second}")], "item_id long, text string")
    swap = lambda text, x, y: text.replace("3", x).replace("5", y)
    texts = {
        1: f"{swap(first, '7', '9')} then later {swap(second, '7', '9')}",
        2: f"{swap(first, '7', '9')} then later {swap(second, '41', '66')}",
        3: f"{swap(first, '7', '9')} {swap(second, '7', '9')} and once more {swap(first, '41', '66')} {swap(second, '41', '66')}",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.kind for r in find_contaminated(docs, items).collect()}
    assert found == {1: "reparameterised", 3: "reparameterised"}
