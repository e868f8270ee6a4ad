import hashlib
import itertools
import random
import zlib

import pytest

from citelake.llm import repair as R
from tests.llm.tables import given

TYPES = "conv_id long, turn long, role string, text string"


# ------------------------------------------------------------- the contract, plainly

def after_damage(rows):
    found = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        held = found.setdefault(conv, [])
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        if kind:
            held += [(turn, role, text)] * (2 if kind == 3 else 1)
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()
    for held in found.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), digest(r)))
    return found


def faults_of(rows):
    found, seen = [], set()
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\f\r")
        found.append(
            "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    return found


def cheapest(rows, faults):
    """Least (cost, audit) over all paths, forwards, by state: the last initial of an unfinished or finished answer."""
    def to(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}.get((state, initial))

    def with_inserts(best):
        for _ in range(2):
            for state, (cost, audit, lines) in list(best.items()):
                for role in ("user", "assistant"):
                    after = to(state, role[0])
                    if after:
                        offer = (cost + 5, audit + "I", [*lines, f"{role}:"])
                        best[after] = min(best.get(after, offer), offer, key=lambda x: x[:2])
        return best

    best = with_inserts({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        offers = {}

        def offer(state, cost, audit, lines):
            if state is not None:
                offers[state] = min(offers.get(state, (cost, audit, lines)), (cost, audit, lines), key=lambda x: x[:2])

        for state, (cost, audit, lines) in best.items():
            offer(state, cost + 2, audit + "D", lines)
            if fault in ("", "truncated"):
                more = 5 if fault else 0
                offer(to(state, role[:1]), cost + more, audit + "K", [*lines, f"{role}:{text}"])
                for new in ("user", "assistant"):
                    offer(to(state, new[0]), cost + more + 1, audit + "R", [*lines, f"{new}:{text}"])
        best = with_inserts(offers)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def plain(rows):
    found = set()
    for conv, held in after_damage(rows).items():
        faults = faults_of(held)
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in held]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, lines = cheapest(held, faults)
        sha = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        found.add((conv, gaps, *counts, illegal, cost, audit, sha))
    return found


def got(spark, rows, most=R.CHUNK):
    return {tuple(r) for r in R.repair_conversations(spark.createDataFrame(rows, TYPES), most).collect()}


def made(seed, conversations, turns):
    rng = random.Random(seed)
    texts = ["One.", "Two!", "Three", "", " \t", "Four?", None, "Fünf – ja.", "long " * 500 + "."]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, ""]
    rows = []
    for conv in range(conversations):
        n = rng.choice(turns)
        for i in range(n):
            usual = ["user", "assistant"][i % 2]
            role = usual if rng.random() < 0.6 else rng.choice(roles)
            text = f"{conv} {i}." if rng.random() < 0.6 else rng.choice(texts)
            rows.append((conv, rng.choice([i, i, i, i + 1, None]), role, text))
    return rows


# ------------------------------------------------------------------------- tests

def test_small_machine_against_plain():
    rng = random.Random(3)
    for _ in range(400):
        symbols = bytes(rng.randrange(16) for _ in range(rng.randrange(7)))
        costs = R.backward(symbols, R.END)
        found = R.trace(symbols, costs, 0, True)
        rows = [(0, {0: "s", 1: "u", 2: "a", 3: "x"}[s >> 2], f"{i}.") for i, s in enumerate(symbols)]
        faults = [("", "truncated", "duplicate", "blank")[s & 3] for s in symbols]
        cost, audit, _ = cheapest(rows, faults)
        assert (found.cost, found.edits.decode()) == (cost, audit)


def test_speculative_vectors_span_true_ones():
    rng = random.Random(4)
    for _ in range(300):
        own = bytes(rng.randrange(16) for _ in range(rng.randrange(1, 9)))
        rest = bytes(rng.randrange(16) for _ in range(rng.randrange(9)))
        end = R.backward(rest, R.END)[0]
        assert max(end) - min(end) <= R.BOUND
        starts = R.speculate(own)
        meant = [min(e + starts[t][s] for t, e in enumerate(end)) for s in range(4)]
        assert R.normal(tuple(meant)) == R.backward(own, end)[0]


@pytest.mark.parametrize("most", [3, 256])
def test_against_plain(spark, most):
    rows = made(most, 60, [0, 1, 2, 3, 8, 30])
    rows += [(None, None, None, None), (None, 3, "user", "Null id."), (-7, None, "user", "x.")]
    assert got(spark, rows, most) == plain(rows)


def test_conversations_over_many_ranges(spark):
    """Few conversations hold nearly all rows: unlike, all alike, all the user's, and all to be deleted."""
    rng = random.Random(9)
    rows = [(7, i, rng.choice(["user", "assistant", "system"]), f"{i}" + rng.choice(["", "."])) for i in range(500)]
    rows += [(8, i, "user", f"{i}.") for i in range(300)]
    rows += [(9, i // 3, "user", "The same.") for i in range(300)]
    rows += [(10, i, "user", "") for i in range(300)] + [(10, 999, "assistant", "Last.")]
    rows += made(1, 4, [3])
    assert got(spark, rows, 16) == plain(rows)


def test_equal_rows_and_nothing(spark):
    rows = [(1, 0, "user", "Same.")] * 40 + [(2, 1, "user", None), (2, 1, "user", None)]
    assert got(spark, rows, 4) == plain(rows)
    empty = R.repair_conversations(spark.createDataFrame([], TYPES))
    assert empty.count() == 0 and empty.columns[0] == "conv_id"


def test_dropped_whole(spark):
    gone = next((c, t) for c, t in itertools.product(range(50), range(9)) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    (row,) = got(spark, [(*gone, "user", "Gone.")])
    assert row == (gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_clashing_columns_and_given_table(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in given("conversations")]
    df = spark.createDataFrame(rows, TYPES)
    for name in ("key", "digest", "symbols", "gone", "part", "sub", "_kind"):
        df = df.selectExpr("*", f"1 as {name}")
    assert {tuple(r) for r in R.repair_conversations(df, 3).collect()} == plain(rows)
