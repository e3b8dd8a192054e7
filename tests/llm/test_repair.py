"""Conversation repair against a search over all edits."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import pytest

from ferryline.llm import repair as R

FORM = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def all_edits(rows):
    """The least (cost, audit) over all edits with at most three insertions, and the lines."""
    best = None
    n = len(rows)
    choices = ["D" if fault in "bd" else "KRD" for _, _, fault in rows]
    for edits in itertools.product(*choices):
        for n_in in range(4):
            for at in itertools.combinations_with_replacement(range(n + 1), n_in):
                audit, lines, free = "", [], []
                for i in range(n + 1):
                    for _ in range(at.count(i)):
                        audit += "I"
                        lines.append(["?", ""])
                    if i < n:
                        audit += edits[i]
                        if edits[i] != "D":
                            lines.append([rows[i][0] if edits[i] == "K" else "?", rows[i][1]])
                cost = sum(
                    {"K": 0, "R": 1, "D": 2}[e] + (5 if f == "t" and e != "D" else 0)
                    for e, (_, _, f) in zip(edits, rows)
                ) + 5 * n_in
                if best is not None and (cost, audit) >= best[:2]:
                    continue
                free = [k for k, line in enumerate(lines) if line[0] == "?"]
                for roles in itertools.product(("user", "assistant"), repeat=len(free)):
                    for k, role in zip(free, roles):
                        lines[k][0] = role
                    if FORM.fullmatch("".join(role[:1] or "?" for role, _ in lines)):
                        best = (cost, audit, "\n".join(":".join(line) for line in lines))
                        break
    return best


def brute(rows):
    """What repair gives for each conversation, by the definition."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked = set(), []
        for _, role, text in own:
            body = text.rstrip(" \t\n\x0b\f\r")
            fault = "b" if not body else "d" if (role, text) in seen else "c" if body[-1] in ".!?" else "t"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
        cost, audit, lines = all_edits(marked)
        counts = [sum(f == x for _, _, f in marked) for x in "bdt"]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())
    return out


def found(spark, rows, **kw):
    df = rows if not isinstance(rows, list) else spark.createDataFrame(rows, SCHEMA)
    made = R.repair(df, **kw)
    digests = {r[0]: r[1] for r in R.digests(made.rows).collect()}
    nothing = hashlib.sha256().hexdigest()
    return {
        r["conv_id"]: (*[r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")],
                       digests.get(r["conv_id"], nothing))
        for r in made.conversations.collect()
    }


def random_rows(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(convs), None]:
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", None])
            text = rng.choice(["Yes.", "No!", "Why?", "cut", "", " \n", None, "Yes. ", "other."])
            if rng.random() < 0.5:
                text = f"{rng.random()}."
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), role, text))
    return rows


@pytest.mark.parametrize("segment_rows", [R.SEGMENT, 2])
def test_equals_search_over_all_edits(spark, segment_rows):
    rows = random_rows(segment_rows, 60, 5)
    assert found(spark, rows, segment_rows=segment_rows) == brute(rows)


def test_one_conversation_in_many_segments(spark):
    """A long conversation that fills several partitions equals the same one in a single segment."""
    rng = random.Random(3)
    roles = ["user", "assistant", "user", "assistant", "system", "tool"]
    texts = ["fine {}.", "cut {}", "same.", " "]
    rows = [(1, t, rng.choice(roles), rng.choice(texts).format(t)) for t in range(700)]
    many = spark.createDataFrame(rows, SCHEMA).repartition(16)
    cut = found(spark, many, segment_rows=7)
    assert cut == found(spark, rows)
    assert len(cut[1][6].replace("I", "")) == 700


def test_rules_change_no_result():
    rng = random.Random(5)
    texts = ["".join(rng.choice(R.ALPHABET) for _ in range(rng.randint(1, 40))) for _ in range(50)]
    plain = R.Grammar().matrices()
    grammar = R.Grammar()
    for _ in range(30):
        counts = R.pair_counts(grammar.compressed(t) for t in texts)
        pair = max(counts, key=lambda p: (counts[p], p))
        grammar.rules.append((chr(0x100 + len(grammar.rules)), pair))
    ruled = grammar.matrices()

    def flat(matrix):
        return [e and (e[0], "".join(R.leaves(e[1]))) for e in matrix]

    for text in texts:
        short = grammar.compressed(text)
        assert len(short) <= len(text)
        assert flat(R.evaluate(short, ruled)) == flat(R.evaluate(text, plain))


def test_learned_rules_are_the_frequent_pairs(spark):
    texts = spark.createDataFrame([("uauaua",), ("suaua",), ("uaX",)], "symbols string")
    rules = R.learn(texts).rules
    assert rules[0][1] == "ua"
    assert all(len(pair) == 2 for _, pair in rules)
    assert len({name for name, _ in rules}) == len(rules)


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", f"Text {c}. Really? {t}!") for c in range(40) for t in range(8)]
    rows += [(None, 1, None, None), (5, None, "user", "a.")]
    want = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        way = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if way == 1:
            text = ""
        if way == 2:
            text = re.sub("[.!?]", "", text)
        if way == 4:
            role = "user"
        want += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(way, 1)
    got = R.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_odd_rows(spark):
    """Clashing names, repeated rows, long texts and an empty table."""
    rows = [(1, 0, "user", "x" * 100_000 + "."), (1, 0, "user", "x" * 100_000 + "."), (1, 1, "", "a."),
            (2, 5, "user", "日本 \U0001f600"), (2, None, "assistant", "ok."), (None, None, None, None)]
    df = spark.createDataFrame([(*r, 1, "q", 2) for r in rows], SCHEMA + ", segment int, symbol string, pos int")
    made = found(spark, df)
    assert made == brute(rows)
    assert made[None] == (0, 1, 0, 0, 0, 2, "D", hashlib.sha256().hexdigest())
    empty = R.repair(df.where("false"))
    assert empty.conversations.collect() == [] and empty.rows.collect() == []


def test_hot_turn(spark):
    """A third of all rows are one row: they are counted before they travel."""
    rows = [(1, 3, "user", "again.")] * 3000 + [(c, 0, "user", "hi.") for c in range(2, 200)]
    made = found(spark, spark.createDataFrame(rows, SCHEMA))
    assert made[1][:7] == (0, 0, 2999, 0, 2999, 6000, "D" * 3000)
