import re

from llm_helpers import edge_docs, no_docs, prose

from tollstream.llm import decontaminate

ITEM = "A train leaves Berlin at 40 km per hour and reaches the old harbour of Hamburg after 7 hours of steady travel."
OTHER = "The committee reviewed every petition twice before the winter session ended and published nine short replies."


def items(spark, rows=((1, ITEM), (2, OTHER))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


def found(spark, texts, bench=None, **settings):
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, hash long")
    rows = decontaminate.leaks(docs, items(spark) if bench is None else bench, **settings).collect()
    return {(r["doc_id"], r["item_id"]): r for r in rows}


def test_exact_reparametrised_and_clean(spark):
    changed = ITEM.replace("40", "65").replace("7", "12").replace("Berlin", "Oslo").replace("Hamburg", "Bergen")
    got = found(spark, [prose(1, 40) + " " + ITEM + " " + prose(2, 30), changed.upper().replace("OSLO", "Oslo"), changed,
                        prose(3, 200), OTHER.lower(), "A train leaves the old harbour."])
    assert {k for k in got} >= {(0, 1), (2, 1), (4, 2)}
    assert not any(k[0] in (3, 5) for k in got)
    assert not got[0, 1]["changed"] and got[2, 1]["changed"]
    assert got[2, 1]["share"] >= 0.8


def test_contradicting_slots_are_no_leak(spark):
    item = "Add 5 apples to 5 pears then take 5 plums and give 5 cherries away before 5 friends come to eat 5 cakes."
    bench = items(spark, [(1, item)])
    values = iter("123456789")
    loose = re.sub("5", lambda m: next(values), item)
    same = item.replace("5", "31")
    got = found(spark, [loose, same], bench)
    assert (1, 1) in got and (0, 1) not in got


def shown(text):
    t = decontaminate.Template(text)
    marks = {decontaminate._NUM: "<n>", decontaminate._IS_UNIT: "<u>", decontaminate._TITLE: "<p>"}
    said = t.said(0, len(t))
    return [marks.get(k, w) for k, w in zip(t.kind.tolist(), said)], said


def test_names_and_units():
    words, said = shown("We paid John Peter Smith 12.50 euros. Then 3 men left; Paris slept.")
    assert words == ["we", "paid", "<p>", "<n>", "<u>", "then", "<n>", "men", "left", "<p>", "slept"]
    assert said[2] == "john peter smith" and said[3] == "12.50"
    assert shown("5 km a day, one Day. Day 3 M")[0] == ["<n>", "<u>", "a", "day", "one", "<p>", "day", "<n>", "<u>"]
    assert shown("")[0] == [] and shown("...")[0] == [] and shown("A")[0] == ["a"]


def test_same_hash_for_same_template():
    a, b, c = (decontaminate.Template(t) for t in ("He met Anna on 4 May", "HE met Bob Dole on 77 MAY", "He met them on 4 May"))
    assert a.hashes[:4].tolist() == b.hashes[:4].tolist() and a.hashes[2] != c.hashes[2]


def test_partial_passage_by_run(spark):
    part = " ".join(OTHER.split()[:13])
    got = found(spark, [prose(5, 20) + " " + part + " " + prose(6, 20), " ".join(OTHER.split()[:9])])
    assert list(got) == [(0, 2)]


def test_many_documents_against_brute_force(spark):
    bench = [(k, prose(1000 + k, 12 + k % 9)) for k in range(40)]
    texts = []
    for i in range(200):
        t = prose(i, 50)
        if i % 5 == 0:
            t += " " + bench[i % 40][1] + " " + prose(i + 5000, 20)
        texts.append(t)
    got = set(found(spark, texts, items(spark, bench)))
    plain = lambda t: " ".join(re.findall(r"\w+", t))
    want = {(i, k) for i, t in enumerate(texts) for k, b in bench if plain(b) in plain(t)}
    assert got == want and want


def test_odd_rows(spark):
    bench = items(spark, [(1, None), (2, ""), (3, "one two three four five six seven"), (None, OTHER), (3, "one two"),
                          (4, "single")])
    rows = decontaminate.leaks(edge_docs(spark), bench).collect()
    hit = {(r["doc_id"], r["item_id"]) for r in rows}
    assert {(1, 3), (9, 3), (5, 4)} <= hit and not any(d in (2, 3, 4) for d, _ in hit)
    docs = edge_docs(spark)
    kept = decontaminate.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["2", "3", "4", "5", "6", "6", "7", "None", "None",
                                                                      "8", "10", "11"])
    assert decontaminate.drop_leaks(no_docs(spark), bench).count() == 0
    assert decontaminate.leaks(docs, items(spark, [])).count() == 0


def test_names_that_open_sentences(spark):
    item = ("Tom has 5 apples in a basket. Tom gives 2 of them to Mary. Mary eats 1 of them at once. How many are left?")
    other = item.replace("Tom", "Boris").replace("Mary", "Helga").replace("5", "9").replace("2", "4").replace("1", "3")
    mixed = other.replace("Boris gives", "Karl gives")  # Tom is two people
    got = found(spark, [f"{prose(1, 20)} {other} {prose(2, 20)}", f"{prose(1, 20)} {item}"], items(spark, [(1, item)]))
    assert (0, 1) in got and got[0, 1]["changed"] and got[0, 1]["share"] == 1
    assert (1, 1) in got and not got[1, 1]["changed"]
    got = found(spark, [mixed], items(spark, [(1, item)]))
    assert (0, 1) not in got or got[0, 1]["share"] < 1


def test_copies_in_any_case(spark):
    got = found(spark, [ITEM.lower(), ITEM.upper(), f"{prose(3, 20)} {ITEM.upper()} {prose(4, 20)}"])
    assert all((k, 1) in got and got[k, 1]["share"] == 1 and not got[k, 1]["changed"] for k in range(3))


def test_items_without_template_windows(spark):
    bench = items(spark, [(1, "What is 48 + 37?"), (2, "12 + 5 - 3 * 2 = 11"), (3, "Anna Bolt: 3 kg, 4 kg, 5 kg")])
    got = found(spark, [f"{prose(1, 20)} What is 48 + 37? {prose(2, 20)}", "Question: what is 48 + 37?", "What is 48 - 37?",
                        "What is 48 + 38?", "so 12 + 5 - 3 * 2 = 11 then", "12 + 5 + 3 * 2 = 23",
                        "ANNA BOLT 3 kg, 4 kg, 5 kg", "Anna Bolt: 3 kg, 4 kg, 6 kg"], bench)
    assert set(got) == {(0, 1), (1, 1), (4, 2), (6, 3)}


def test_short_items_behind_colons_and_line_ends(spark):
    item = "What is the boiling point of water?"
    got = found(spark, [f"Question: {item}", f"A heading\n{item}", f"A heading {item}", "What is the price of water?"],
                items(spark, [(1, item)]))
    assert set(got) == {(0, 1), (1, 1), (2, 1)} and all(r["share"] == 1 for r in got.values())
    assert shown("Question: What is it\nThen Anna")[0] == ["question", "what", "is", "it", "then", "<p>"]


BIG = 1 << 60


def test_large_ids_beside_a_null_stay_exact(spark):
    bench = items(spark, [(BIG + 7, ITEM), (None, OTHER)])
    docs = spark.createDataFrame([(BIG + 1, ITEM), (None, OTHER), (BIG + 3, prose(1, 40)), (BIG + 5, OTHER)],
                                 "doc_id long, text string").coalesce(1)
    rows = decontaminate.leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(BIG + 1, BIG + 7), (None, None), (BIG + 5, None)}
    assert [r["doc_id"] for r in decontaminate.drop_leaks(docs, bench).collect()] == [BIG + 3]


def test_items_shorter_than_a_window_are_whole_sentences(spark):
    bench = items(spark, [(1, "4"), (2, "Water boils"), (3, "Name three rivers.")])
    got = found(spark, ["The answer is 4 apples.", "Cold water boils late.", "Well: name three rivers\nthen rest.",
                        "4", "It said 4.\n4\nand left", "Water boils. Ice melts."], bench)
    assert set(got) == {(2, 3), (3, 1), (4, 1), (5, 2)}


def test_texts_read_together_do_not_mix(spark, monkeypatch):
    """Windows, names in a row and sentence ends stop at the end of a text."""
    parts = [OTHER[:40], OTHER[40:], "", "Anna", "Bolt", ITEM, "And then", "", ITEM]
    together = decontaminate.Tokens(parts)
    for layer in decontaminate.LAYERS:
        whole = decontaminate.Template(together, layer)
        alone = [decontaminate.Template(p, layer) for p in parts]
        assert whole.hashes.tolist() == [h for t in alone for h in t.hashes.tolist()]
        for n in (1, 3, 5):
            for bounded in (False, True):
                h, good = whole.windows(n, 3, bounded)
                want = [x for t in alone for x in (lambda w: w[0][w[1]].tolist())(t.windows(n, 3, bounded))]
                assert h[good].tolist() == want


def test_bitmap_grows_with_the_windows():
    assert decontaminate._bitmap_bits(0) == 16 and decontaminate._bitmap_bits(10**4) == 24
    assert decontaminate._bitmap_bits(10**9) == decontaminate.MOST_BITS


TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?:\n]|[-+*/=<>×÷−^](?=\s*\d)")


def test_tokens_are_those_of_the_pattern(monkeypatch):
    import random

    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 20)  # in many parts
    rnd = random.Random(3)
    parts = ["a", "Bo", "OK", "12", "3.5", ",", ".", "-", "+ ", "  ", "\n", "'", "km", "=", "- \n", "é", "É", "^", "\t", "9",
             "_", "²", "٣", "日本", "\U0001d400", "\U0001f600", "\0", "ǅ", "x’y", " The ", " word"]
    for _ in range(400):
        texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(40))) for _ in range(rnd.randrange(1, 4))]
        read = decontaminate.Tokens(texts)
        want = [TOKEN.findall(t) for t in texts]
        assert [read.text[a:b] for a, b in zip(read.start, read.stop)] == [t for w in want for t in w]
        assert read.owner.tolist() == [k for k, w in enumerate(want) for _ in w]
        flat = [t for w in want for t in w]
        title = [len(t) > 1 and t[0].isupper() and t[1:].islower() for t in flat]
        assert read.title.tolist() == title
        unit = [t.lower() in decontaminate.UNITS for t in flat]
        assert (read.kind == decontaminate._IS_UNIT).tolist() == unit
        by_word = {}
        for t, h in zip(flat, read.hashes.tolist()):
            assert by_word.setdefault(t.lower(), h) == h
        assert len(set(by_word.values())) == len(by_word)


def test_key_windows_are_in_every_leak(spark):
    """For each item: any 80 % of the windows, and any run of 13 words, hold
    a key window; windows of many items are left out where there are others."""
    import itertools
    import math

    rows = [(k, 0, 0, i, 1000 * k + i if i > 2 else i, 7, 5, ["w"]) for k in range(20) for i in range(7)]
    rows += [(99, 0, 0, i, 5000 + i, 40, 5, ["w"]) for i in range(40)]
    df = spark.createDataFrame([(str(a), *r) for a, *r in rows], decontaminate.ITEMS)
    keys = decontaminate.key_windows(df, 0.8, 13).collect()
    by_item = {}
    for r in keys:
        by_item.setdefault(r["item_id"], set()).add(r["i_at"])
    for k in range(20):
        need = math.ceil(0.8 * 7)
        assert all(set(c) & by_item[str(k)] for c in itertools.combinations(range(7), need))
        assert not {0, 1, 2} & by_item[str(k)]
    assert all(set(range(a, a + 9)) & by_item["99"] for a in range(32))
    assert len(by_item["99"]) <= 9 + 8


def test_a_window_of_all_items(spark):
    """Items that share most of a template and differ in the rest."""
    stem = "Here is what everyone who reads this should know about"
    bench = [(k, f"{stem} {prose(k, 6)}") for k in range(30)]
    texts = [f"{prose(100 + k, 8)} {bench[k][1]} {prose(200 + k, 8)}" for k in range(10)]
    texts += [f"{stem} {prose(500 + k, 9)}" for k in range(40)]
    assert set(found(spark, texts, items(spark, bench))) == {(k, k) for k in range(10)}
