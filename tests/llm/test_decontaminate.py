import random

from lakeloom.llm import decontaminate as dec
from lakeloom.llm.common import documents
from corpora import corpus, prose

ITEMS = [
    (1, "A train of 120 km length leaves Berlin station at 8 h with 120 seats and meets Anna near the old bridge of stone."),
    (2, "The quick river then carried small wooden boats slowly past many green gardens before sunset came again."),
    (3, "too short now"), (4, None)]


def found(spark, stored, rows):
    out = dec.op9_decontaminate(spark, stored(rows, benchmark=ITEMS)).collect()
    return {(r.doc_id, r.item_id): r for r in out}


def test_verbatim_reparameterised_and_inconsistent(spark, stored):
    rng = random.Random(1)
    mixed = lambda t: prose(rng, 30) + " " + t + " " + prose(rng, 30)
    rows = [
        (10, mixed(ITEMS[0][1])), (11, mixed(ITEMS[1][1])),
        (12, mixed(ITEMS[0][1].replace("120", "77").replace("8 h", "9 min").replace("Anna", "Otto").replace("Berlin", "Madrid"))),
        (13, mixed(ITEMS[0][1].replace("120 km", "77 km").replace("Berlin", "Madrid"))),  # 120 seats stay: two values for one
        (14, mixed(" ".join(ITEMS[1][1].split()[:7]))), (15, ITEMS[1][1].upper()), (16, None), (17, ""), (10, mixed(ITEMS[0][1])),
        (18, ITEMS[2][1])]
    got = found(spark, stored, rows + [(d + 1000, t) for d, t in corpus(8, 30) if d is not None])
    assert set(got) == {(10, 1), (11, 2), (12, 1), (15, 2)}
    assert got[10, 1].verbatim and not got[12, 1].verbatim and got[10, 1].n_slots > 3


def brute(text, item):
    """Is the item's row of words in the text's? For texts without slots."""
    import re
    a, b = ([w.lower() for w in re.findall(r"[^\W\d_]+", t or "")] for t in (text, item))
    return len(b) >= dec.WINDOW and any(a[i:i + len(b)] == b for i in range(len(a)))


def test_plain_passages_equal_brute_force(spark, stored):
    rng = random.Random(5)
    items = [(i, prose(rng, rng.randint(4, 30))) for i in range(12)]
    rows = [(d, t) for d, t in corpus(9, 30) if d is not None]
    rows += [(2000 + i, prose(rng, 20) + "\n" + t + "\n" + prose(rng, 20)) for i, t in items]
    out = dec.op9_decontaminate(spark, stored(rows, benchmark=items)).collect()
    assert {(r.doc_id, r.item_id) for r in out} == {(d, i) for d, t in rows for i, x in items if brute(t, x)}


def test_shuffled_join_beyond_the_bound_and_clean_rows(spark, stored, clashing, monkeypatch):
    rows = [(1, ITEMS[1][1]), (2, "all clear " * 20), (3, None)]
    folder = stored(rows, benchmark=ITEMS)
    docs, items = clashing(folder), spark.read.parquet(f"{folder}/benchmark.parquet")
    monkeypatch.setattr(dec, "BROADCAST_WINDOWS", 0)
    monkeypatch.setattr("lakeloom.llm.common.BROADCAST_ROWS", -1)
    left = dec.without_leaks(docs, items)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [2, 3]
    assert dec.leaks(documents(spark, stored([], "none")), items).count() == 0


def test_names_in_any_shape(spark, stored):
    one, tom = ITEMS[0][1], "Tom buys 12 red apples at the market. Tom eats 5 of them. How many apples are left?"
    rows = list(enumerate([
        one.replace(" Berlin", "\nBerlin"), one.replace(" Berlin", "  Berlin"), one.replace("Berlin", '"Berlin"'), one.upper(), one.lower(),
        one.replace("Berlin", "New York"), one.replace("Berlin", "New\nYork").replace("120", "77").replace("Anna", "Mary Ann"),
        one.replace("Berlin", "New York").replace("120 km", "77 km"), tom, tom.replace("Tom", "Anna").replace("12", "31"),
        "Tom sells 3 green pears in the garden. Anna eats some of them."]))
    out = dec.op9_decontaminate(spark, stored(rows, benchmark=[(1, one), (2, tom)])).collect()
    got = {(r.doc_id, r.item_id): r for r in out}
    assert set(got) == {*((i, 1) for i in range(7)), (8, 2), (9, 2)}
    assert [got[i, 1].verbatim for i in range(7)] == [True] * 5 + [False] * 2 and not got[9, 2].verbatim
    assert all(r.n_places == 1 for r in out)


def test_long_runs_of_names_and_digits_do_not_overflow(spark, stored):
    rows = [(1, "Word Here " * 500_000 + ITEMS[1][1]), (2, "1" + ".1" * 1_000_000), (3, "Ab " * 1_000_000), (4, "7" * 1_000_000)]
    assert set(found(spark, stored, rows)) == {(1, 2)}


def test_marked_and_plain_tokens_are_the_same(spark):
    from pyspark.sql import functions as F
    rng = random.Random(2)
    bits = ["Berlin", "New", "5", "12.5", "km", "Km", "KM", " ", "  ", "\n", ".", ",", "a", "the", "İstanbul", "mm", "é", "X", "IBM",
            "McX", "1", "́", "𝐀b", "5.", "3,4", "km/h", "Ünd"]
    rows = [("".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(0, 25))),) for _ in range(2000)]
    bare = F.transform(dec.marked_tokens(F.col("text")), lambda t: F.translate(t, dec.NAME + dec.FIRST + dec.END, ""))
    assert spark.createDataFrame(rows, "text string").where(dec.tokens(F.col("text")) != bare).count() == 0
    out = dec.windows(spark.createDataFrame([(1, "we saw İstanbul and 12 apples")], "k int, text string"), "k", "text").collect()
    assert {s.value for r in out if r.plain for s in r.slots or []} == {"12"}


def test_edited_items_are_found_and_unrelated_ones_are_not(spark, stored):
    """Recall over items of 14 words and more with one word altered, dropped or inserted for every sixteen windows."""
    rng = random.Random(11)
    items = [(i, prose(rng, rng.randint(14, 60), line=99)) for i in range(60)]
    rows = []
    for i, text in items:
        for kind in range(3):
            words = text.split(" ")
            for _ in range(1 if len(words) < 25 else 2):
                at = rng.randrange(len(words))
                words[at:at + 1] = [["zzalter"], [], ["zzinsert", words[at]]][kind]
            rows.append((1000 * (kind + 1) + i, prose(rng, 30) + " " + " ".join(words) + " " + prose(rng, 30)))
    clean = [(9000 + i, prose(rng, 120)) for i in range(60)]
    got = set(found_items(spark, stored(rows + clean, benchmark=items)))
    hits = sum((d, d % 1000) in got for d, _ in rows)
    assert hits / len(rows) >= 0.95, hits / len(rows)
    assert all(i == d % 1000 for d, i in got) and not any(d >= 9000 for d, _ in got)


def found_items(spark, folder):
    return [(r.doc_id, r.item_id) for r in dec.op9_decontaminate(spark, folder).collect()]
