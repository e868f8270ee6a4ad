import itertools
import random
import re

import pytest

from citelake.llm.decontaminate import LEAST_WORDS, MASKS, clean_documents, overlaps
from tests.llm.tables import ODD_ROWS, SF, documents, given, widened


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def brute(docs, items):
    """(doc, item) → longest overlap over all ways to lay the two texts over each other."""
    out = {}
    for d, text in docs:
        a = words(text)
        for i, item in items:
            b = words(item)
            least = min(13, len(b))
            best = 0
            for shift in range(-len(b) + 1, len(a)) if b else ():
                run = [a[shift + k] == b[k] for k in range(len(b)) if 0 <= shift + k < len(a)]
                if len(run) < least or sum(run) < 0.8 * least:
                    continue
                for n in range(len(run), max(best, least - 1), -1):
                    if any(5 * sum(run[s : s + n]) >= 4 * n for s in range(len(run) - n + 1)):
                        best = n
                        break
            if best:
                out[d, i] = best
    return out


BENCH = "item_id long, text string"


def test_first_mask_hits_every_window_with_two_substitutions():
    mask = MASKS[0]
    for n in (0, 1, 2):
        for changed in itertools.combinations(range(LEAST_WORDS), n):
            assert any(
                all(mask[k] == "0" or s + k not in changed for k in range(len(mask)))
                for s in range(LEAST_WORDS - len(mask) + 1)
            )


def made(seed):
    rng = random.Random(seed)
    pick = lambda n: [f"w{rng.randint(0, 400)}" for _ in range(n)]
    items = [(i, " ".join(pick(rng.choice([1, 2, 4, 6, 9, 12, 13, 20, 40])))) for i in range(30)]
    docs = []
    for d in range(120):
        body = pick(rng.randint(0, 60))
        if d % 2:
            leak = rng.choice(items)[1].split()
            a = rng.randint(0, len(leak) // 3)
            leak = leak[a:]
            for _ in range(rng.randint(0, len(leak) // 4)):
                leak[rng.randrange(len(leak))] = "changed"
            body[len(body) // 2 : len(body) // 2] = [w.upper() + rng.choice(["", ",", "."]) for w in leak]
        docs.append((d, "  ".join(body)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs, items = made(seed)
    want = brute(docs, items)
    df = documents(spark, [(i, t, "s") for i, t in docs])
    bench = spark.createDataFrame(items, BENCH)
    got = {(r.doc_id, r.item_id): r.length for r in overlaps(df, bench).collect()}
    assert set(got) == set(want) and len(want) > 20
    leaked = {d for d, _ in want}
    assert sorted(r.doc_id for r in clean_documents(df, bench).collect()) == [d for d, _ in docs if d not in leaked]


def test_blocks_give_the_same(spark, monkeypatch):
    import citelake.llm.decontaminate as module

    docs, items = made(3)
    df, bench = documents(spark, [(i, t, "s") for i, t in docs]), spark.createDataFrame(items, BENCH)
    whole = sorted(map(tuple, overlaps(df, bench).collect()))
    monkeypatch.setattr(module, "BLOCK_ITEMS", 7)
    assert sorted(map(tuple, overlaps(df, bench).collect())) == whole
    leaked = {r[0] for r in whole}
    assert {r.doc_id for r in clean_documents(df, bench).collect()} == {d for d, _ in docs} - leaked


def test_given_table(spark):
    docs = [(d["doc_id"], d["text"]) for d in given("documents")]
    items = [(b["item_id"], b["text"]) for b in given("benchmark")]
    df, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in overlaps(df, bench).collect()}
    plain = {(d, i) for d, t in docs for i, b in items if " ".join(words(b)) in " ".join(words(t))}
    assert plain <= got and got == set(brute(docs, items))


def test_odd_rows(spark):
    wide = widened(documents(spark, ODD_ROWS))
    bench = spark.createDataFrame(
        [(1, None), (2, ""), (3, "here again"), (3, "here again"), (None, "long long long"), (5, "no id at all")], BENCH
    )
    got = sorted((r.doc_id or -1, r.item_id, r.matched) for r in overlaps(wide, bench).collect())
    assert got == [(-1, 5, 4), (5, 3, 2), (6, 3, 2), (6, 3, 2)]
    clean = clean_documents(wide, bench)
    assert clean.columns == wide.columns
    assert sorted(r.doc_id or -1 for r in clean.collect()) == [-1, 1, 2, 3, 4, 8]
    none = spark.createDataFrame([], BENCH)
    assert overlaps(wide, none).collect() == [] and clean_documents(wide, none).count() == len(ODD_ROWS)
    assert overlaps(documents(spark, []), bench).collect() == []


def test_masks_hit_every_overlap_of_up_to_24_words():
    ones = [([i for i, c in enumerate(m) if c == "1"], len(m)) for m in MASKS]
    for n in range(LEAST_WORDS, 25):
        windows = [sum(1 << (at + i) for i in places) for places, span in ones for at in range(n - span + 1)]
        for k in range(n // 5 + 1):
            for changed in itertools.combinations(range(n), k):
                held = sum(1 << i for i in changed)
                assert any(not held & w for w in windows), (n, changed)
