import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from contractlake.llm.suffix import (
    longest_previous_factors,
    merged,
    remove_repeats,
    smaller_before,
    suffix_ranks,
    whole_characters,
)

SCHEMA = "doc_id long, text string"


def plain(rows, length, first_stays):
    """Per row: bytes, removed, runs, digest of the bytes left, by comparing all strings."""
    data = [(t or "").encode() for _, t in rows]
    places = defaultdict(list)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    for i in order:
        for p in range(len(data[i]) - length + 1):
            places[data[i][p : p + length]].append((i, p))
    out = []
    for i, whole in enumerate(data):
        cover = np.zeros(len(whole) + 2, bool)
        for p in range(len(whole) - length + 1):
            found = places[whole[p : p + length]]
            if len(found) > 1 and not (first_stays and found[0] == (i, p)):
                cover[p + 1 : p + 1 + length] = True
        kept = bytes(b for b, c in zip(whole, cover[1:]) if not c)
        runs = int((np.diff(cover.astype(int)) == 1).sum())
        out.append((rows[i][0], len(whole), len(whole) - len(kept), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def digest(frame):
    return Counter((r.row.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in frame.collect())


def corpus(seed, n=40):
    rng = random.Random(seed)

    def prose(size):
        return " ".join("".join(rng.choices("abcdeéß", k=rng.randint(2, 9))) for _ in range(size))

    passages = [prose(20), prose(60)]
    base = prose(80)
    rows = []
    for i in range(n):
        parts = [prose(rng.randint(0, 30))]
        if i % 2:
            parts.append(passages[0])
        if i % 5 == 0:
            parts += [passages[1], prose(5), passages[1]]
        if i % 7 == 0:
            place = rng.randrange(len(base))
            parts.append(base[:place] + "#" + base[place:])
        if i % 11 == 0:
            parts.append("again and " * 60)
        rows.append((i, " ".join(parts)))
    rows += [(3, rows[3][1]), (None, rows[5][1]), (90, None), (91, ""), (92, "x" * 900), (93, "y" * 61)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("first_stays", [False, True])
@pytest.mark.parametrize("max_stretches", [1000, 2])
def test_equals_comparison_of_all_strings(spark, first_stays, max_stretches):
    """With few stretches allowed, most anchors are dealt out factor by factor."""
    rows = corpus(3)
    if first_stays:  # ties of the key are broken by row, which a shuffled list leaves open
        rows = [r for r in rows if r[0] != 3]
    frame = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    got = remove_repeats(frame, "doc_id", 60, 16, first_stays, max_stretches)
    assert digest(got) == plain(rows, 60, first_stays)


def test_first_copy_stays_whole(spark):
    rows = [(5, "p" + "abc def ghi " * 1 + "q" * 10), (1, "unique words of a passage that is long enough to count here")]
    rows += [(2, rows[1][1]), (9, "before " + rows[1][1] + " after")]
    got = {r.row.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, SCHEMA), "doc_id", 40, 8).collect()}
    assert got[1].text == rows[1][1] and got[1].n_removed == 0
    assert got[2].text == "" and got[9].text == "before  after"


def test_rank_orders_by_prefix():
    data = np.frombuffer(b"banana_bandana_banana", np.uint8).astype(np.int64) + 1
    text = bytes(data.astype(np.uint8) - 1)
    for length in (1, 3, 7, 8, 15):
        levels = suffix_ranks(data, length)
        assert levels[-1][0] == length
        for size, rank in levels:
            prefixes = [text[i : i + size] for i in range(len(text))]
            known = sorted(set(prefixes))
            assert rank.tolist() == [known.index(p) for p in prefixes]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 300])
def test_smaller_before(n):
    rng = np.random.default_rng(n)
    for values in (rng.permutation(n), np.arange(n), np.arange(n)[::-1], -rng.permutation(n)):
        values = values.astype(np.int32)
        want = [max((j for j in range(i) if values[j] < values[i]), default=-1) for i in range(n)]
        assert smaller_before(values).tolist() == want


def shared(a, b, most):
    n = 0
    while n < min(len(a), len(b), most) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("length", [3, 7, 20, 61, 200])
@pytest.mark.parametrize("letters", [1, 2, 4, 200])
def test_longest_previous_factors(length, letters):
    """Equal to comparing every suffix with all earlier ones, on random bytes with copies in them."""
    rng = random.Random(length * letters)
    text = bytes(rng.randrange(letters) for _ in range(300))
    text += text[40:160] + bytes(rng.randrange(letters) for _ in range(50)) + text[40:300]
    data = np.append(np.frombuffer(text, np.uint8).astype(np.int64) + 1, np.zeros(1, np.int64))
    levels = suffix_ranks(data, length)
    places = np.arange(len(text) - length + 1)
    for order in (places, rng.sample(places.tolist(), len(places))):
        when = np.empty(len(places), np.int32)
        when[order] = np.arange(len(places))
        by = np.lexsort((when, levels[-1][1][places]))
        found = longest_previous_factors(levels, data, places[by], when[by])
        for place, n in zip(by.tolist(), found.tolist()):
            best = max((shared(text[place:], text[other:], length) for other in places if when[other] < when[place]), default=0)
            assert n == best


def test_spans():
    assert merged(np.array([5, 0, 2]), np.array([1, 1, 1]), 3).tolist() == [[0, 8]]
    assert merged(np.array([9, 0]), np.array([1, 1]), 3).tolist() == [[0, 3], [9, 12]]
    data = "aéb".encode()
    assert whole_characters(data, np.array([[0, 2]])).tolist() == [[0, 1]]
    assert whole_characters(data, np.array([[2, 4]])).tolist() == [[3, 4]]


def test_awkward(crowded, no_documents):
    got = remove_repeats(crowded, "doc_id").collect()
    assert len(got) == crowded.count()
    for r in got:
        if r.row.doc_id == 7:  # one letter 70,000 times: the first 200 are what a later string repeats
            assert r.n_removed == 70_000 - 1
        if r.row.doc_id == 6:
            assert r.n_removed == 0
        if r.row.doc_id == 2:
            assert r.text is None and r.n_bytes == 0
    assert set(got[0].row.asDict()) == set(crowded.columns) - {"text"}
    assert remove_repeats(no_documents, "doc_id").count() == 0
