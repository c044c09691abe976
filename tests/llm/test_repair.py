import hashlib
import itertools
import random
import re
import zlib

from pyspark.sql import types as T

from bureauframe.llm import repair

SCHEMA = T.StructType(
    [T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
     T.StructField("text", T.StringType()), T.StructField("cost", T.StringType()), T.StructField("symbols", T.StringType())]
)
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SPACE = " \t\n\x0b\x0c\r"


def damage(conv, turn, role, text):
    role, text = " " if role is None else role, " " if text is None else text
    key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
    kind = zlib.crc32(key.encode()) % 20
    if kind == 0:
        return []
    if kind == 1:
        text = ""
    if kind == 2:
        text = re.sub("[.!?]", "", text)
    if kind == 4:
        role = "user"
    return [(turn, role, text)] * (2 if kind == 3 else 1)


def cheapest(rows):
    """Best (cost, edits, output) per state by whole strings, row by row. Rows: role, text, fault."""
    step = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    best = {0: (0, "", ())}

    def put(table, state, cost, edits, lines):
        if state is not None and (state not in table or (cost, edits) < table[state][:2]):
            table[state] = (cost, edits, lines)

    def inserted(table):
        out = dict(table)
        for _ in range(2):
            for state, (cost, edits, lines) in list(out.items()):
                for r in ("user", "assistant"):
                    put(out, step[r[0]].get(state), cost + 2, edits + "I", (*lines, f"{r}:"))
        return out

    for role, text, fault in rows:
        after = {}
        for state, (cost, edits, lines) in inserted(best).items():
            put(after, state, cost + 3, edits + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            late = fault == "truncated"
            put(after, step.get(role[:1], {}).get(state), cost + late, edits + "K", (*lines, f"{role}:{text}"))
            for r in ("user", "assistant"):
                put(after, step[r[0]].get(state), cost + 2 + late, edits + "R", (*lines, f"{r}:{text}"))
        best = after
    return min(found for state, found in inserted(best).items() if state in (0, 3))


def plain(rows):
    conversations = {}
    for conv, turn, role, text in rows:
        own = conversations.setdefault(conv, [])
        own += [r for r in damage(conv, turn, role, text)]
    out = []
    for conv, own in conversations.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))
        seen, marked = set(), []
        for _, role, text in own:
            last = text.rstrip(SPACE)
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "" if last[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {t for t, *_ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, audit, lines = cheapest(marked)
        counts = [sum(f == k for *_, f in marked) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "c", "s") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in repair.repair(frame).select(COLUMNS).collect()), key=str)


def corpus(seed, conversations):
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(conversations)]:
        roles = ["user", "assistant"] * 30
        if rng.random() < 0.4:
            roles.insert(0, "system")
        for turn, role in enumerate(roles[: rng.choice([1, 2, 4, 5, 8, 40])]):
            if rng.random() < 0.1:
                continue
            role = rng.choice([role] * 8 + ["user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", f"Well {turn}?", f"And {conv}.\n", "cut off", "", " \x0b", None, "ü…", "a\nb. "])
            rows.append((conv, rng.choice([turn] * 12 + [None, 3]), role, text))
    return rows


def test_against_whole_strings(spark):
    rows = corpus(1, 250)
    got = found(spark, rows)
    assert got == plain(rows)
    assert len({r[7] for r in got}) > 100 and {c for r in got for c in r[7]} == set("KRDI")


def test_small_and_empty(spark):
    assert found(spark, []) == []
    rows = [(c, t, None, None) for c in (None, 1, 2) for t in (None, 0, 0)] + [(5, -(1 << 63), "user", "a."), (5, (1 << 63) - 1, "user", "b.")]
    got = found(spark, rows)
    want = plain(rows)
    assert [r for r in got if r[0] != 5] == [r for r in want if r[0] != 5] and len(got) == len(want)


def test_long_conversation(spark):
    rng = random.Random(2)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No", f"It is {t}."])) for t in range(20_000)]
    assert found(spark, rows) == plain(rows)


def test_matrices_against_whole_strings():
    rng = random.Random(3)
    role = {"s": "system", "u": "user", "a": "assistant", "o": "tool", "x": "user"}
    for n in [0, 1, 2, 3, 5, 9, 30] * 40:
        symbols = "".join(rng.choice(repair.SYMBOLS) for _ in range(n))
        rows = [(role[s.lower()], "", "blank" if s == "x" else "truncated" if s.isupper() else "") for s in symbols]
        rules = []
        for _ in range(6):
            short = repair.compressed(symbols, rules)
            if len(short) > 1:
                i = rng.randrange(len(short) - 1)
                rules.append(short[i : i + 2])
        short = repair.compressed(symbols, rules)
        assert repair.repaired(short, repair.matrices(rules)) == cheapest(rows)[:2]


def test_cheapest_against_every_edit():
    def every(symbols):
        best = None
        for edits in itertools.product(*[["".join(x) for k in range(3) for x in itertools.product("I", repeat=k)]] * (len(symbols) + 1)):
            for ops in itertools.product("KRD", repeat=len(symbols)):
                state, cost, audit = 0, 0, ""
                for ins, op, s in itertools.zip_longest(edits, ops, symbols):
                    for _ in ins:
                        state, cost, audit = {0: 2, 1: 2, 2: 3, 3: 2}[state], cost + 2, audit + "I"
                    if op is None:
                        continue
                    audit += op
                    if op == "D":
                        cost += 3
                    elif s == "x":
                        break
                    else:
                        cost += s.isupper() + 2 * (op == "R")
                        if op == "R":
                            state = {0: 2, 1: 2, 2: 3, 3: 2}[state]
                        else:
                            state = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(s.lower(), {}).get(state)
                            if state is None:
                                break
                else:
                    if state in (0, 3) and (best is None or (cost, audit) < best):
                        best = (cost, audit)
        return best

    rng = random.Random(4)
    for n in [0, 1, 2, 2, 3, 3]:
        for _ in range(4):
            symbols = "".join(rng.choice(repair.SYMBOLS) for _ in range(n))
            assert repair.repaired(symbols, repair.matrices([])) == every(symbols)
