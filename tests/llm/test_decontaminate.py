import random

from edge import documents, no_documents

from semprune.llm import decontaminate as d


def distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_myers_is_the_edit_distance():
    r = random.Random(5)
    for _ in range(200):
        item = "".join(r.choice("abc ") for _ in range(r.randint(1, 80)))
        text = "".join(r.choice("abc ") for _ in range(r.randint(0, 90)))
        assert d.myers(item, text)[0] == distance(item, text)


def edited(r, text, n):
    for _ in range(n):
        at = r.randrange(len(text))
        text = r.choice([text[:at] + "#" + text[at:], text[:at] + text[at + 1 :], text[:at] + "~" + text[at + 1 :]])
    return text


def same_words(item, text, at):
    """The item at this place, and no letter or digit joined to its own first or last one."""
    word = lambda c: c.isalpha() or c.isnumeric()
    before, behind = text[:at][-1:], text[at + len(item) :][:1]
    return text.startswith(item, at) and not (before and word(before) and word(item[0])) and not (behind and word(behind) and word(item[-1]))


def planted():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(r.randint(12, 50)).capitalize()) for i in range(12)] + [(99, "shorT"), (98, None), (97, ""), (96, " \n"), (0, prose(20))]
    items += [(100 + n, ("What is two plus two? Four, or five or so")[:n]) for n in range(1, 41)] + [(150, "a"), (151, "?!"), (152, prose(3)), (153, prose(5))]
    texts = [prose(60) for _ in range(20)]
    for i, text in items[:12]:
        for n in (0, 1, len(text) // 20, len(text) // 20 + 3, len(text) // 8):
            texts.append(prose(20) + "  " + edited(r, text, n).replace(" ", " \n", 2) + " " + prose(10))
    for i, text in items[18:]:
        if text:
            texts += [f"{prose(5)} {text}, {prose(3)}", f"{prose(3)}{text}{prose(2)}", text.upper(), text[1:] + " " + text[:-1]]
    texts.append(items[0][1] + prose(3000) + items[1][1])
    return items, texts


def test_all_items_within_budget_are_found(spark):
    items, texts = planted()
    docs = documents(spark, texts)
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, `a.b` string")
    expected = set()
    for r in docs.select("doc_id", "text").distinct().collect():
        text = d.normal(r.text)
        for item_id, item in items:
            item = d.normal(item)
            if 0 < len(item) < 32:
                found = any(same_words(item, text, at) for at in range(len(text)))
            else:
                found = item and (item in text or (len(text) < 2000 and distance(item, text) <= len(item) // 20))
            if found:
                expected.add((r.doc_id, item_id))
    assert len(expected) > 150
    for block in (d.BLOCK_BYTES, 500):
        found = d.find_items(docs, bench, block).collect()
        assert {(r.doc_id, r.item_id) for r in found} == expected
        clean = d.drop_contaminated(docs, bench, block)
        assert clean.columns == docs.columns
        hit = {doc for doc, _ in expected}
        assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r.doc_id) for r in docs.collect() if r.doc_id not in hit)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert d.find_items(documents(spark), none).count() == 0
    assert d.drop_contaminated(documents(spark), none).count() == documents(spark).count()
    some = spark.createDataFrame([(1, "x" * 50)], "item_id long, text string")
    assert d.find_items(no_documents(spark), some).count() == 0
