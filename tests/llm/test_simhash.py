import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from shelfline.llm.simhash import drop_near_duplicates, fingerprint, fingerprint_links, simhash_components, spanning_links

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(pairs, nodes):
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def test_fingerprint_against_its_definition(spark):
    texts = ["The cat SAT on the mat", "one", "Two words", "", None, " \t\n", "a b c", "é É à\xa0b c d E", "x y " * 40]
    assert [fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]
    # Spark's own hash agrees for a text of one shingle.
    (row,) = spark.sql("select lower(hex(xxhash64('a b c'))) h").collect()
    assert int(row.h, 16) == fingerprint("A b c")


@pytest.mark.parametrize("tile_rows", [1024, 3])
def test_links_connect_what_all_pairs_connect(spark, tile_rows):
    draw = random.Random(2)
    prints = {draw.getrandbits(64) for _ in range(300)}
    for p in list(prints)[:60]:
        for _ in range(draw.randrange(6)):
            p ^= sum({1 << draw.randrange(64) for _ in range(draw.randrange(1, 6))})
            prints.add(p)
    prints |= {0, (1 << 64) - 1, 7, 15, 1}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = [tuple(r) for r in fingerprint_links(spark.createDataFrame(signed, "bits long"), tile_rows=tile_rows).collect()]
    nodes = [p for (p,) in signed]
    near = [(a, b) for a in nodes for b in nodes if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3]
    assert classes(links, nodes) == classes(near, nodes)
    assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3 for a, b in links)


def test_dense_group_gives_few_links():
    group = np.array([sum(1 << i for i in range(12) if k >> i & 1) for k in range(4096)], dtype=np.uint64)
    a, _ = spanning_links(group, None, 3)
    assert len(a) == 4095
    a, _ = spanning_links(group[:2000], group[2000:], 3)
    assert len(a) <= 4095


def texts():
    draw = random.Random(4)
    base = [" ".join(draw.choice("abcdefghij") * draw.randrange(1, 5) for _ in range(draw.randrange(1, 120))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t + " extra") for i, t in enumerate(base)]
    rows += [(200 + i, base[i % 3].upper()) for i in range(40)]
    return rows + [(400, None), (300, ""), (301, " \n"), (500, "w " * 100_000), (500, "w " * 100_000), (None, base[0]), (None, None)]


def test_components_against_brute_force(spark):
    rows = texts()
    found = simhash_components(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    prints = [plain_fingerprint(t) for _, t in rows]
    root = classes([(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3], range(len(rows)))
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        least[root[i]] += [doc] * (doc is not None)
    expected = [(doc, f"{prints[i]:016x}", min(least[root[i]])) for i, (doc, _) in enumerate(rows)]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_one_row_of_each_component_stays(spark):
    rows = [(*r, "x", i) for i, r in enumerate(texts())]
    df = spark.createDataFrame(rows, SCHEMA + ", component_id string, key int")
    left = drop_near_duplicates(df).collect()
    ids = {r.component_id for r in simhash_components(df).collect()}
    assert len(left) == len(ids) and {r.doc_id for r in left} == ids
    assert list(left[0].asDict()) == ["doc_id", "text", "component_id", "key"]


def test_empty_table_and_null_keys_only(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash_components(empty).collect() == [] and drop_near_duplicates(empty).collect() == []
    nulls = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "z")], SCHEMA)
    assert {r.component_id for r in simhash_components(nulls).collect()} == {None}
    assert sorted(r.text for r in drop_near_duplicates(nulls).collect()) == ["a b c d", "z"]
