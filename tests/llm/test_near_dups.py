import random

import pytest

from citelake.llm.near_dups import components, near_duplicates
from tests.llm.tables import ODD_ROWS, SF, WORD, documents, given, widened

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width):
    """doc_id → (size, smallest id reachable), every pair compared. Ids must be unique."""
    sets = {i: shingles(t, width) for i, t in rows}
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            a, b = sets[i], sets[j]
            if min(len(a), len(b)) * 100 >= max(len(a), len(b)) * 80:
                both = len(a & b)
                if 100 * both >= 80 * (len(a) + len(b) - both):
                    x, y = sorted((find(i), find(j)))
                    up[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def check(out, rows, width):
    want = brute(rows, width)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in out}
    assert len(out) == len(rows)
    assert got == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)


@pytest.mark.parametrize("width", [2, 5])
def test_given_table(spark, width):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    check(near_duplicates(df, width).collect(), [(d["doc_id"], d["text"]) for d in given("documents")], width)


def families(seed, edits):
    """Large families of near copies around the threshold, and small sets of common words."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for family in range(4):
        base = [rng.choice(words) + str(family) for _ in range(rng.choice([12, 40, 90, 200]))]
        for _ in range(60):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // edits))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    rows += [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(250)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,edits,width", [(1, 14, 2), (2, 8, 2), (3, 25, 5)])
def test_families(spark, seed, edits, width):
    rows = families(seed, edits)
    check(near_duplicates(documents(spark, [(i, t, "s") for i, t in rows]), width).collect(), rows, width)


def test_long_lists_are_refined(spark, monkeypatch):
    """Every list counts as long: the result must not change."""
    import citelake.llm.near_dups as module

    monkeypatch.setattr(module, "LONG", 1)
    rows = families(4, 9)
    check(near_duplicates(documents(spark, [(i, t, "s") for i, t in rows]), 2).collect(), rows, 2)


def test_chain(spark):
    """Links need not be direct: each text differs from the next in a little only."""
    words = [f"x{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 3 : i * 3 + 100])) for i in range(90)]
    check(near_duplicates(documents(spark, [(i, t, "s") for i, t in rows]), 2).collect(), rows, 2)


def test_odd_rows(spark):
    out = near_duplicates(widened(documents(spark, ODD_ROWS)), 2).collect()
    assert len(out) == len(ODD_ROWS)
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out if r.doc_id is not None)
    assert got == [
        (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 3, 5, True),
        (6, 3, 5, False), (6, 3, 5, False), (7, 2, 7, True),
        (8, len(shingles(ODD_ROWS[-1][1], 2)), 8, True),
    ]
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None] == [(None, True)] * 2
    assert near_duplicates(documents(spark, [])).collect() == []


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (7, 200)]
    df = spark.createDataFrame([(bytes([a]), bytes([b])) for a, b in edges], "a binary, b binary")
    got = {r.f[0]: r.root[0] for r in components(df).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 200: 0, 100: 100, 101: 100, 102: 100}


def test_one_of_each_group(spark):
    from citelake.llm.near_dups import one_of_each_group

    rows = [*ODD_ROWS, (9, "a b c d e f g h i j k l", "s"), (9, "z y x w v u t", "s"), (10, "A b c d e f g h i j k l m", "s")]
    wide = widened(documents(spark, rows))
    out = one_of_each_group(wide)
    assert out.columns == wide.columns
    got = sorted(((r.doc_id or -1), len(r.text or "")) for r in out.collect())
    want = [(i or -1, len(t or "")) for i, t, _ in rows if i not in (6, 10)]
    assert got == sorted(want)
    twice = documents(spark, [(1, "a b c d e f", "s")] * 3 + [(2, "a b c d e f", "s"), (3, "q", "s")])
    assert sorted(r.doc_id for r in one_of_each_group(twice).collect()) == [1, 3]


def test_short_template_in_long_lists(spark):
    """Every text that adds two own words to the eight of a template is linked with it, though each list is long."""
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    texts = [" ".join(words)] + [" ".join([*words, f"own{i}", f"too{i}"]) for i in range(1, 300)]
    # Nine words of which eight are common, and no template among them.
    nine = [" ".join([f"n{j}" for j in range(8)] + [f"last{i}"]) for i in range(200)]
    docs = documents(spark, [(i, t, "a") for i, t in enumerate(texts)] + [(1000 + i, t, "b") for i, t in enumerate(nine)])
    got = {r.doc_id: r.component_id for r in near_duplicates(docs, width=1).collect()}
    assert {got[i] for i in range(300)} == {0}
    assert {got[1000 + i] for i in range(200)} == {1000}


def half_alike(seed, passage, own, edits):
    """Texts around one passage, most of them alike to 50 to 80 %, and copies of one text with some words exchanged."""
    rng = random.Random(seed)
    common, base = ([f"{c}{i}" for i in range(n)] for c, n in (("p", passage), ("b", passage + own)))
    rows = [" ".join([*common, *(f"o{k}x{i}" for i in range(rng.randint(own // 3, own)))]) for k in range(150)]
    for k in range(150):
        copy = list(base)
        for at in rng.sample(range(len(base)), rng.randint(0, edits)):
            copy[at] = f"e{k}x{at}"
        rows.append(" ".join(copy))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed,passage,own,edits,width", [(6, 90, 60, 11, 2), (7, 100, 70, 5, 5)])
def test_half_alike_texts_are_no_candidates(spark, monkeypatch, seed, passage, own, edits, width):
    """Results as by brute force, from far fewer exact comparisons than the group has pairs."""
    import citelake.llm.near_dups as module

    compared = []
    plain = module._similar

    def similar(pairs, *more):
        out = plain(pairs, *more)
        compared.append(out.count())
        return out

    monkeypatch.setattr(module, "_similar", similar)
    monkeypatch.setattr(module, "LONG", 16)
    rows = half_alike(seed, passage, own, edits)
    check(near_duplicates(documents(spark, [(i, t, "s") for i, t in rows]), width).collect(), rows, width)
    assert sum(compared) < 20 * len(rows)
