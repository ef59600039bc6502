import re

from muster.llm.surrogates import _luhn, entities, replace_entities, resolve, script, surrogate

TEXT = (
    "Mail Ann.Lee+7@mail3.shop.de or ann.lee+7@mail3.shop.de, call +1 (434) 555-2368 or 030-1234-5678. Card 4539 1488 0343 6467, "
    "host 45.196.222.209, ssn 123-45-6789. Mr. John Smith met Mrs. Anna SMITH and Dr. Smith; г-н Иван Петров. DE89 3704 0044 0532 0130 00."
)


def kinds(text):
    return [(text[s:e], k) for s, e, k, *_ in entities(text)]


def test_entities_are_found():
    assert kinds(TEXT) == [
        ("Ann.Lee+7", "mail"), ("mail3.shop.de", "domain"), ("ann.lee+7", "mail"), ("mail3.shop.de", "domain"), ("+1 (434) 555-2368", "phone"),
        ("030-1234-5678", "phone"), ("4539 1488 0343 6467", "card"), ("45.196.222.209", "ip"), ("123-45-6789", "ssn"), ("John", "given-m"), ("Smith", "surname"),
        ("Anna", "given-f"), ("SMITH", "surname"), ("Smith", "surname"), ("Иван", "given-m"), ("Петров", "surname"), ("DE89 3704 0044 0532 0130 00", "account")]
    for text in ("", "version 1.2.3 of 2024-01-02", "300.1.1.1 and 1.2.3.4.5", "12 34 56", "a@b", "The Mr was here", "x" * 100_000, "1" * 40):
        assert kinds(text) == []


def test_all_words_and_mentions_of_a_name():
    text = "Mr Juan Carlos Garcia Lopez met Mrs Ann Day. Lopez's wife saw Juan Lopez, GARCIA and Lopez-Day; a day ago J. Lopezz. Dr. J. F. Kent left. J said Kent's."
    found = [(text[s:e], k) for s, e, k, *_ in entities(text)]
    assert found == [
        ("Juan", "given-m"), ("Carlos", "given-m"), ("Garcia", "given-m"), ("Lopez", "surname"), ("Ann", "given-f"), ("Day", "surname"), ("Lopez", "surname"),
        ("Juan", "given-m"), ("Lopez", "surname"), ("GARCIA", "given-m"), ("Lopez", "surname"), ("Day", "surname"), ("J", "given-n"), ("F", "given-n"),
        ("Kent", "surname"), ("Kent", "surname")]


def test_one_person_has_one_name_under_different_titles(spark):
    texts = ["Ms Mary Jones spoke. Dr. Mary Jones agreed, and so did Mary.", "Mr John left. Mr John Smith stayed. Dr. John spoke.", "Prof. Mary Kent wrote.",
             "Ms Day came. Dr. Kim Day left.", "Mr Kim Day came. Ms Kim Lee came. Dr. Kim Poe left."]
    assert [[k for *_, k in kinds(t)] for t in texts] == [
        ["given-f", "surname", "given-f", "surname", "given-f"], ["given-m", "given-m", "surname", "given-m"], ["given-n", "surname"],
        ["surname", "given-f", "surname"], ["given-m", "surname", "given-f", "surname", "given-n", "surname"]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = {r.doc_id: r.text for r in replace_entities(docs).collect()}
    first, last = made[0].split()[1:3]
    assert made[0] == f"Ms {first} {last} spoke. Dr. {first} {last} agreed, and so did {first}."
    assert made[2].startswith(f"Prof. {first} ")
    own, name = made[1].split()[1], made[1].split()[5]
    assert made[1] == f"Mr {own} left. Mr {own} {name} stayed. Dr. {own} spoke."


def test_rounds_do_not_grow_with_names(spark, monkeypatch):
    monkeypatch.setattr("muster.llm.surrogates.MAX_ROUNDS", 12)
    rows = [("given-f:LATIN", f"name{i}") for i in range(3000)] + [("given-m:GREEK", f"n{i}") for i in range(3)]
    rows += [("surname:LATIN", f"s{i}") for i in range(3000)] + [("mail:x.de", str(i)) for i in range(10)]
    settled = resolve(spark.createDataFrame(rows, "space string, norm string"), b"k").collect()
    assert len(settled) == len(rows) == len({(r.space, r.surrogate) for r in settled})
    assert not {(r.space, r.surrogate) for r in settled} & set(rows)


def test_mentions_get_the_surrogate_of_the_name(spark):
    docs = spark.createDataFrame([(1, "Mr. John Smith came. Smith said that John Smith's car went."), (2, "John Smith has no title here.")], "doc_id long, text string")
    text = {r.doc_id: r.text for r in replace_entities(docs, count_col="n").collect()}
    first, last = text[1].split()[1], text[1].split()[2]
    assert text[1] == f"Mr. {first} {last} came. {last} said that {first} {last}'s car went." and first != "John" and last != "Smith"
    assert text[2] == "John Smith has no title here."


def test_surrogates_keep_type_and_format(spark):
    docs = spark.createDataFrame([(1, TEXT, 5), (2, "Mr. Smith wrote to ann.lee+7@mail3.shop.de.", 6), (3, None, 7), (4, "", 8), (5, "nothing here", 9), (1, TEXT, 5)], "doc_id long, text string, _row int")
    made = replace_entities(docs, count_col="n")
    assert made.columns == ["doc_id", "text", "_row", "n"]
    rows = made.collect()
    assert len(rows) == 6
    text = {r.doc_id: r.text for r in rows}
    assert len({r.text for r in rows if r.doc_id == 1}) == 1
    assert text[3] is None and text[4] == "" and text[5] == "nothing here"
    for (_, old), (_, new) in zip([x for x in kinds(TEXT)], kinds(text[1])):
        assert old == new
    for (old, kind), (new, _) in zip(kinds(TEXT), kinds(text[1])):
        assert old != new and script(old) == script(new)
        if kind in ("phone", "card", "ssn", "account"):
            assert re.sub(r"\w", "", old) == re.sub(r"\w", "", new)
    words = dict(zip([x for x, _ in kinds(TEXT)], [x for x, _ in kinds(text[1])]))
    assert words["Smith"].upper() == words["SMITH"] and words["Ann.Lee+7"].lower() == words["ann.lee+7"]
    assert text[2] == f"Mr. {words['Smith']} wrote to {words['ann.lee+7']}@{words['mail3.shop.de']}."
    digits = re.sub(r"\D", "", words["4539 1488 0343 6467"])
    assert _luhn(digits[:-1]) == int(digits[-1]) and words["+1 (434) 555-2368"].startswith("+1 (")
    other = replace_entities(docs, key=b"another").collect()
    assert {r.text for r in other} != {r.text for r in rows}


def test_collisions_are_drawn_again(spark):
    names = ["adam", "bruno", "carl", "david", *[f"name{i}" for i in range(60)]]
    found = spark.createDataFrame([("given-m:LATIN", n) for n in names] + [("ssn:9", "123456789")], "space string, norm string")
    rows = resolve(found, b"k").collect()
    given = [r for r in rows if r.space != "ssn:9"]
    assert len(rows) == len(names) + 1
    assert len({r.surrogate for r in given}) == len(names)
    assert not {r.surrogate for r in given} & set(names)
    assert surrogate("ip", "10.1.2.3", b"k", 0).startswith("10.")


def test_exhausted_shapes_settle(spark):
    """More originals than half of a shape has possibilities, and a domain with nothing to draw."""
    names = [("mail:x.de", chr(97 + i)) for i in range(26)] + [("mail:y.de", str(i)) for i in range(10)] + [("domain", "-.com"), ("domain", "a.com")]
    rows = resolve(spark.createDataFrame(names, "space string, norm string"), b"k").collect()
    assert len(rows) == len(names) == len({(r.space, r.surrogate) for r in rows})
    assert not {(r.space, r.surrogate) for r in rows} & set(names)
    assert all(re.fullmatch(r"[a-z0-9]+" if r.space != "domain" else r"-?[a-z]+\.com", r.surrogate) for r in rows)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert replace_entities(empty).collect() == []
