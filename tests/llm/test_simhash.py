import random
import re

import numpy as np
import pytest
import xxhash
from edge import documents, no_documents

from semprune.llm import simhash
from semprune.session import materialize


def fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) > 4 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(near):
    label = np.arange(len(near))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def near_matrix(prints, budget):
    return np.bitwise_count(prints[:, None] ^ prints[None, :]) <= budget


def test_fingerprints_and_components_of_documents(spark):
    docs = documents(spark).repartition(3)
    rows = simhash.near_copies(docs).collect()
    assert len(rows) == docs.count()
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    prints = np.array([fingerprint(t) for _, t in texts], np.uint64)
    label = components(near_matrix(prints, 4))
    smallest = {}
    for (doc_id, _), k in zip(texts, label, strict=True):
        if doc_id is not None:
            smallest[k] = min(smallest.get(k, doc_id), doc_id)
    expected = sorted((str(d), int(p), smallest[k]) for (d, _), p, k in zip(texts, prints, label, strict=True))
    assert sorted((str(r.id), r.print % (1 << 64), r.component) for r in rows) == expected


@pytest.mark.parametrize("budget, tile", [(4, 4096), (4, 40), (0, 4096), (7, 30)])
def test_links_close_to_those_of_all_pairs(spark, budget, tile):
    r = random.Random(7)
    centres = [r.getrandbits(64) for _ in range(60)]
    leaves = set(centres)
    for n in range(900):
        c = centres[0] if n < 300 else r.choice(centres)
        for _ in range(r.randint(1, 9)):
            c ^= 1 << r.randrange(64)
        leaves.add(c)
    leaves |= {0, (1 << 64) - 1, 0b11111}
    prints = np.array(sorted(leaves), np.uint64)
    label = components(near_matrix(prints, budget))
    rows = [(i, int(p)) for i, p in enumerate(prints.view(np.int64))]
    table = materialize(spark.createDataFrame(rows, "leaf long, print long").repartition(4), "leaves")
    links = materialize(simhash.close_links(table, budget, tile), "links")
    roots = {x.node: x.root for x in simhash.components(links).collect()}
    assert [roots.get(i, i) for i in range(len(prints))] == label.tolist()
    if tile == 4096:
        assert links.count() < 20 * len(prints)


def test_a_crowd_costs_few_links():
    values = np.sort(np.array([sum(1 << b for b in bits) for bits in [(i, j) for i in range(40) for j in range(i)]], np.uint64))
    label = simhash.link_leaves(values, np.zeros(len(values), np.int64), 4)
    assert (label == 0).all()


def test_no_documents(spark):
    assert simhash.near_copies(no_documents(spark)).count() == 0
