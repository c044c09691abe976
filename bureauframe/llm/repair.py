"""Conversations with faults and their cheapest repair.

Each row becomes a symbol: its role's initial and its fault. The distinct symbol sequences of all
conversations are compressed by Re-Pair: the most frequent adjacent symbols become a rule, round by
round. A symbol is a min-plus matrix over the states of the role grammar (nothing yet, system, user,
assistant), a rule the product of two, and a sequence a product of few matrices. Entries carry the
edits as a rope, so equal stretches share their repairs.

Ties are compared without expanding ropes. A matrix holds the insertions before its rows and ends with
the edit of a row, so two edit strings from one state to different ones differ before either ends: the
order among them is a rank, and a product's ranks follow from its factors'.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bureauframe.llm.common import durable, importable

SPACE = r" \t\n\u000B\f\r"
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1  # costs
#: Row symbols: role initial, upper case where truncated; `o` for other roles, `x` for rows that must go.
SYMBOLS = "suaoSUAOx"
RULES = 128  #: of the grammar; their matrices are all a task holds beside its sequences
ROUNDS = 10  #: passes over the distinct sequences, each of which adds rules of disjoint pairs
FIRST_RULE = 0x100  #: rules are code points from here on

START, SYSTEM, USER, ASSISTANT = range(4)
_USER = {START: USER, SYSTEM: USER, ASSISTANT: USER}
_NEXT = {"s": {START: SYSTEM}, "u": _USER, "a": {USER: ASSISTANT}, "o": {}}
_ADDED = _USER | {USER: ASSISTANT}  # what an inserted or re-roled row becomes

#: For each state: end state -> (cost, rank among the ends, rope).
Matrix = Sequence[dict[int, tuple[int, int, object]]]


# -- matrices -------------------------------------------------------------------------------------


def _insertions(state: int) -> Iterator[tuple[int, int, str]]:
    """End state, cost and edits of nothing, one or two insertions; more never pay."""
    edits = ""
    for _ in range(3):
        yield state, INSERT * len(edits), edits
        state, edits = _ADDED[state], edits + "I"


def _ranked(row: dict[int, tuple]) -> dict[int, tuple]:
    """Entries (cost, order, rope) with the order replaced by its rank."""
    ranks = {order: i for i, order in enumerate(sorted(order for _, order, _ in row.values()))}
    return {t: (cost, ranks[order], rope) for t, (cost, order, rope) in row.items()}


def symbol_matrix(symbol: str) -> Matrix:
    """Insertions, then one row kept, re-roled or deleted."""
    late = TRUNCATED if symbol.isupper() else 0
    out = []
    for start in range(4):
        row: dict[int, tuple] = {}
        for state, cost, edits in _insertions(start):
            ways = [(state, DELETE, "D")]
            if symbol != "x":
                ways.append((_ADDED[state], REROLE + late, "R"))
                kept = _NEXT[symbol.lower()].get(state)
                if kept is not None:
                    ways.append((kept, late, "K"))
            for end, more, edit in ways:
                found = cost + more, edits + edit, edits + edit
                row[end] = min(row.get(end, found), found)
        out.append(_ranked(row))
    return out


def _row(left: dict[int, tuple], right: Matrix) -> dict[int, tuple]:
    """A row of a product: of equal costs the least edits, which the ranks tell."""
    best: dict[int, tuple] = {}
    for middle, (cost, rank, rope) in left.items():
        for end, (more, rank2, rope2) in right[middle].items():
            found = cost + more, (rank, rank2), (rope, rope2)
            if end not in best or found[:2] < best[end][:2]:
                best[end] = found
    return _ranked(best)


def matrices(rules: Iterable[str]) -> dict[str, Matrix]:
    """The matrix of every symbol and, bottom up, of every rule (a pair of earlier symbols)."""
    out = {s: symbol_matrix(s) for s in SYMBOLS}
    for i, (a, b) in enumerate(rules):
        out[chr(FIRST_RULE + i)] = [_row(row, out[b]) for row in out[a]]
    return out


def expanded(rope) -> str:
    parts, stack = [], [rope]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            parts.append(node)
        else:
            stack += node[::-1]
    return "".join(parts)


def repaired(symbols: str, known: dict[str, Matrix]) -> tuple[int, str]:
    """Cost and edits of the cheapest repair of a sequence of symbols and rules."""
    row = {START: (0, 0, "")}
    for symbol in symbols:
        row = _row(row, known[symbol])
    ends = []
    for state, (cost, rank, rope) in row.items():
        for end, more, edits in _insertions(state):
            if end in (START, ASSISTANT):
                ends.append((cost + more, rank, edits, rope))
    cost, _, edits, rope = min(ends, key=lambda e: e[:3])
    return cost, expanded(rope) + edits


# -- grammar --------------------------------------------------------------------------------------


def compressed(symbols: str, rules: Sequence[str]) -> str:
    for i, pair in enumerate(rules):
        symbols = symbols.replace(pair, chr(FIRST_RULE + i))
    return symbols


def pair_counts(symbols: str) -> Counter[str]:
    """Adjacent pairs; those of one symbol twice do not overlap."""
    counts = Counter(map("".join, zip(symbols, symbols[1:], strict=False)))
    for pair in [p for p in counts if p[0] == p[1]]:
        counts[pair] = symbols.count(pair)
    return counts


def grammar(sequences: DataFrame) -> list[str]:
    """Re-Pair rules over all `symbols`. A round takes its most frequent pairs that have no symbol
    in common, so that none changes the count of another. Pairs are counted in Spark; at most one
    count for each two of the symbols and rules, a bounded number, reaches the driver."""
    rules: list[str] = []

    def each(batches):
        counts: Counter[str] = Counter()
        for batch in batches:
            for symbols in batch.column("symbols").to_pylist():
                counts += pair_counts(compressed(symbols, rules))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["pair", "n"]
        )

    for _ in range(ROUNDS):
        counted = sequences.select("symbols").mapInArrow(each, "pair string, n long")
        found = counted.groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1").collect()
        used: set[str] = set()
        before = len(rules)
        for pair, _ in sorted(found, key=lambda r: (-r.n, r.pair)):
            if used.isdisjoint(pair) and len(rules) < RULES:
                used.update(pair)
                rules.append(pair)
        if len(rules) in (before, RULES):
            break
    return rules


def repairs(sequences: DataFrame, rules: list[str]) -> DataFrame:
    """symbols, cost, audit for each of the distinct sequences."""

    def each(batches):
        known = matrices(rules)
        for batch in batches:
            found = [repaired(compressed(s, rules), known) for s in batch.column("symbols").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("symbols"), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())],
                ["symbols", "cost", "audit"],
            )

    return sequences.select("symbols").mapInArrow(each, "symbols string, cost long, audit string")


# -- rows -----------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, dropped: rows as damage leaves them; a dropped one stays, marked.
    NULL roles and texts read as one space, and so do NULL numbers where damage is drawn."""
    number = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(number("conv_id"), F.lit(":"), number("turn"))) % 20
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), kind.alias("kind")
    )
    text = (
        F.when(F.col("kind").isin(0, 1), "")
        .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("dropped"), F.explode(copies).alias("copy")
    )
    return out.drop("copy")


#: Rows of one turn go by role and digest of the text, so copies are adjacent.
ORDER = ("turn", "role", "digest")


def _digest() -> Column:
    return F.unhex(F.md5("text"))


SUMMARY = "conv_id long, symbols string, gaps long, blank long, duplicate long, truncated long, illegal long"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")
_LONGEST = (1 << 63) - 1
LEGAL = {"su", "ua", "au"}


def summaries(rows: DataFrame) -> DataFrame:
    """A row for each conversation: symbols and counts. Rows travel without their texts; a task
    reads one conversation after another and keeps a symbol for each of its rows."""
    trimmed = F.expr(f"trim(TRAILING '{SPACE}' FROM text)")
    flagged = rows.select(
        "conv_id",
        "turn",
        "role",
        "dropped",
        F.when(~F.col("dropped"), _digest()).alias("digest"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(*".!?")).alias("cut"),
    )
    # One exchange, by conversation, serves the window and the order after it.
    nth = "row_number() OVER (PARTITION BY conv_id, role, digest ORDER BY turn) > 1 AS again"
    numbered = flagged.repartition("conv_id").selectExpr("*", nth)
    fault = (
        F.when(F.col("dropped"), "-").when(F.col("blank"), "b").when(F.col("again"), "d").when(F.col("cut"), "t").otherwise("k")
    )
    slim = numbered.select("conv_id", "turn", "role", "digest", fault.alias("fault"))
    slim = slim.sortWithinPartitions("conv_id", *ORDER)
    slim = slim.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "fault")

    def each(batches):
        out: list[tuple] = []
        conv, state = None, None

        def close():
            if state:
                counts, symbols, turns, _ = state
                gaps = min(turns[1] - turns[0] + 1 - turns[2], _LONGEST) if turns[2] else 0
                out.append((conv, symbols.decode(), gaps, counts["b"], counts["d"], counts["t"], counts["illegal"]))

        for batch in batches:
            for c, turn, initial, fault in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if state is None or c != conv:
                    close()
                    conv, state = c, (Counter(), bytearray(), [0, 0, 0], [None])
                if fault == "-":
                    continue
                counts, symbols, turns, last = state
                counts[fault] += 1
                if last[0] is not None and last[0] + initial not in LEGAL:
                    counts["illegal"] += 1
                last[0] = initial
                if turn is not None and (not turns[2] or turn != turns[1]):
                    turns[:] = [turns[0] if turns[2] else turn, turn, turns[2] + 1]
                symbol = "x" if fault in "bd" else initial if initial and initial in "sua" else "o"
                symbols += (symbol.upper() if fault == "t" else symbol).encode()
            if out:
                yield _summary(out)
        close()
        if out:
            yield _summary(out)

    def _summary(out):
        columns = list(zip(*out, strict=True))
        out.clear()
        kinds = [pa.int64(), pa.string(), *[pa.int64()] * 5]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "symbols", *_COUNTS]
        )

    return importable(slim).mapInArrow(each, SUMMARY)


class Repairer:
    """Applies an audit to the rows of a conversation as they come, and hashes what is left."""

    def __init__(self, audit: str):
        self.edits, self.state = iter(audit), START
        self.hash, self.between = hashlib.sha256(), ""

    def _add(self, role: str | None, text: str) -> None:
        if role is None:
            self.state = _ADDED[self.state]
            role = "user" if self.state == USER else "assistant"
        self.hash.update(f"{self.between}{role}:{text}".encode())
        self.between = "\n"

    def row(self, role: str, text: str) -> None:
        while (edit := next(self.edits)) == "I":
            self._add(None, "")
        if edit == "K":
            self.state = _NEXT[role[0]][self.state]
            self._add(role, text)
        elif edit == "R":
            self._add(None, text)

    def digest(self) -> str:
        for _ in self.edits:
            self._add(None, "")
        return self.hash.hexdigest()


RESULT = SUMMARY.replace("symbols string, ", "") + ", cost long, audit string, repaired_sha256 string"


def written(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """Apply the edits: each conversation's audit travels to its rows once, ahead of them, and the
    repaired text is hashed as it streams by."""
    columns = ["conv_id", *_COUNTS, "cost", "audit"]
    heads = audits.select(*columns, F.lit(0).alias("kind"))
    bodies = rows.filter("NOT dropped").select("conv_id", "turn", "role", "text", _digest().alias("digest"), F.lit(1).alias("kind"))
    merged = heads.unionByName(bodies, allowMissingColumns=True)
    merged = merged.repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER)

    def each(batches):
        out: list[tuple] = []
        head, repairer = None, None

        def close():
            if head:
                out.append((*head, repairer.digest()))

        def flush():
            found = list(zip(*out, strict=True))
            out.clear()
            kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(found, kinds, strict=True)], [*columns, "repaired_sha256"]
            )

        for batch in batches:
            heads_ = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
            body = zip(*(batch.column(c).to_pylist() for c in ("kind", "role", "text")), strict=True)
            for row, (kind, role, text) in zip(heads_, body, strict=True):
                if kind:
                    repairer.row(role, text)
                else:
                    close()
                    head, repairer = row, Repairer(row[-1])
            if out:
                yield flush()
        close()
        if out:
            yield flush()

    return importable(merged).mapInArrow(each, RESULT)


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for every
    conv_id of `conversations` (conv_id, turn, role, text), NULL included.

    Rows of one turn that are no copies go by role, then by MD5 of the text. NULL turns come first,
    NULL roles and texts read as one space. A conversation that loses all rows has zeros, an empty
    audit and the hash of the empty string. Other columns are not looked at. No rows, no result rows.
    A conversation's hash is sequential, so one task streams its rows in order, whatever their
    number; it keeps the audit and one batch."""
    rows = damaged(conversations)
    found = durable(summaries(rows))
    sequences = durable(found.select("symbols").distinct())
    fixed = repairs(sequences, grammar(sequences))
    return written(rows, found.join(fixed, "symbols"))
