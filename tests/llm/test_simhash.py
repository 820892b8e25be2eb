import random

import numpy as np
import pytest
import xxhash

from contractlake.llm.components import components
from contractlake.llm.simhash import fingerprint, simhash_classes, similar_prints

from llm.plain_helpers import Groups, words


def plain_fingerprint(text, n=3):
    found = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return 0
    shingles = [found[i : i + n] for i in range(len(found) - n + 1)] or [found]
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t ", "One", "One two", "A b C d e", "Ä ä\x1dx y " * 9, "a b " * 20_000])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def signed(value):
    return int(np.array([value], np.uint64).view(np.int64)[0])


def prints(seed):
    rng = random.Random(seed)
    found = {rng.getrandbits(64) for _ in range(120)}
    for value in sorted(found)[:40]:
        for _ in range(12):
            other = value
            for _ in range(rng.randint(1, 4)):
                other ^= 1 << rng.randrange(64)
            found.add(other)
    centre = rng.getrandbits(64)
    for _ in range(150):
        other = centre
        for _ in range(rng.randint(0, 6)):
            other ^= 1 << rng.randrange(20)
        found.add(other)
    return sorted(found)


@pytest.mark.parametrize("max_group", [1 << 16, 12])
def test_links_join_what_close_pairs_join(spark, max_group):
    """With small groups every key is taken apart and the last pass works part by part."""
    values = prints(7)
    groups = Groups(range(len(values)))
    array = np.array(values, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(array[i] ^ array[i + 1 :]) <= 3):
            groups.link(i, i + 1 + int(j))
    frame = spark.createDataFrame([(signed(v),) for v in values], "print long")
    links = similar_prints(frame, 3, max_group).collect()
    place = {signed(v): i for i, v in enumerate(values)}
    found = Groups(range(len(values)))
    for link in links:
        assert (values[place[link.u]] ^ values[place[link.v]]).bit_count() <= 3
        found.link(place[link.u], place[link.v])
    assert [found.least(i) for i in range(len(values))] == [groups.least(i) for i in range(len(values))]


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(shape)
    nodes = rng.sample(range(-(10**12), 10**12), 200)
    links = {
        "path": list(zip(nodes, nodes[1:])),
        "star": [(nodes[0], n) for n in nodes[1:]] + [(nodes[1], nodes[1]), (nodes[2], nodes[0])],
        "random": [tuple(rng.sample(nodes, 2)) for _ in range(110)],
        "none": [],
    }[shape]
    groups = Groups(nodes)
    for a, b in links:
        groups.link(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    linked = {n for a, b in links if a != b for n in (a, b)}
    assert got == {n: groups.least(n) for n in linked}


def test_awkward(crowded, no_documents):
    rows = crowded.select("doc_id", "text").collect()
    got = simhash_classes(crowded).collect()
    assert len(got) == len(rows)
    expected = {}
    for r in rows:
        expected.setdefault(r.doc_id, set()).add(format(plain_fingerprint(r.text), "016x"))
    assert all(r.fingerprint in expected[r.doc_id] for r in got)
    of = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    assert of[8, format(plain_fingerprint("One two three. " * 40), "016x")] == 1
    assert of[3, "0" * 16] == of[4, "0" * 16] == of[2, "0" * 16] == 2
    assert simhash_classes(no_documents).count() == 0


def test_large_group_of_copies(spark):
    frame = spark.range(5000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same text here', concat('text ', id, ' ', id * 7)) AS text")
    got = simhash_classes(frame).where("component_id = 0").count()
    assert got >= 1667
