"""BPE encoding by tree concatenation, and the word-cached encoder it and the writer share.

A text is halved until the pieces are short; the pieces are encoded on their own and joined pairwise.
At a join the tokens next to the cut may be wrong, so a window of tokens around it is encoded again,
and grows until it agrees with the left side at its left end and with the right side at its right
end. Two neighbouring tokens of a BPE encoding are right or wrong whatever surrounds them, hence the
agreement at both ends makes the whole sequence exact (`tests/llm/test_bpe.py` compares with the
library on hostile texts).
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bureauframe.llm.common import importable

LEAF_CHARS = 8_192  #: longest piece that is encoded at once
TASK_CHARS = 262_144  #: longer texts are cut into segments that are encoded by separate tasks
WINDOW_TOKENS = 12  #: tokens on each side of a join that are encoded again at first
CACHE_UNITS = 300_000  #: words, and other units, whose ids a worker remembers
CACHED_CHARS = 32  #: longer units are not remembered

#: Rows handed to Python are regrouped so that this many characters are worked on at once.
BATCH_CHARS = 1_000_000

_LETTERS = r"[^\W\d_]+"
UNITS = re.compile(rf" ?{_LETTERS}(?:'{_LETTERS})*|(?:(?! ?{_LETTERS}).)+", re.S)


def _odd_letters(unit: str) -> bool:
    """Numbers that are no digits (superscripts, Roman numerals) count as letters in UNITS only."""
    body = unit.replace("'", "").lstrip(" ")
    return body[:1].isalnum() and not body.isalpha() and not body[:1].isdecimal()


def _reads_on(unit: str) -> bool:
    """Apostrophes and the last of several white-space characters depend on the letters after."""
    return unit[-1] == "'" or unit[-2:].isspace() and len(unit) > 1


#: Whether native unsigned integers are anything but little-endian 32-bit numbers.
_WIDE = array("I").itemsize != 4 or sys.byteorder != "little"


def _blob(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes() if _WIDE else array("I", ids).tobytes()


def numbers(blob: bytes) -> list[int]:
    return np.frombuffer(blob, "<u4").tolist()


class _NoWord(Exception):
    """White space follows a space: words do not encode apart there."""


class _NoUnit(Exception):
    """A unit that may not be encoded by itself."""


class _Remembered(dict):
    """Ids by text, in two generations of half of CACHE_UNITS: what was met since the older one was
    closed survives the next."""

    def __init__(self, encoder: Encoder) -> None:
        self.encoder = encoder
        self.older: dict[str, bytes] = {}

    def keep(self, text: str, ids: bytes) -> None:
        if len(self) >= CACHE_UNITS // 2:
            self.older = dict(self)
            self.clear()
        self[text] = ids


class _Pieces(_Remembered):
    """Ids of units."""

    def __missing__(self, unit: str) -> bytes:
        out = self.older.get(unit)
        if out is None:
            if _reads_on(unit) or _odd_letters(unit):
                raise _NoUnit
            out = self.encoder.piece(unit)
        if len(unit) <= CACHED_CHARS:
            self.keep(unit, out)
        return out


class _Words(_Remembered):
    """Ids of words with the space before them. A word before a comma or full stop is remembered by
    itself too."""

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            if word.isalpha():
                out = self.encoder.piece(" " + word)
            elif not word or word[0].isspace():
                raise _NoWord
            elif word[-1] in ".," and word[:-1].isalpha():
                out = self[word[:-1]] + self.encoder.pieces[word[-1]]
            else:
                out = self.encoder.cut(" " + word)
        if len(word) <= CACHED_CHARS and "\n" not in word:
            self.keep(word, out)
        return out


class Encoder:
    """The tokenizers library's file at `path`, with its ids for words remembered.

    Ids are kept as bytes of little-endian 32-bit numbers: joining them needs no loop over ids.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [
            t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content
        ]
        special_ids = set(self.tokenizer.get_added_tokens_decoder())
        # The byte each character of the byte-level alphabet stands for: printable Latin-1
        # characters stand for themselves, the rest for the characters from U+0100 on, in order.
        kept = [c for c in sorted(map(ord, ByteLevel.alphabet())) if c < 256]
        others = [b for b in range(256) if b not in set(kept)]
        byte_of = {chr(c): c for c in kept} | {chr(256 + i): b for i, b in enumerate(others)}
        self.token_bytes: list[bytes] = []
        for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True)):
            token = self.tokenizer.id_to_token(i) or ""
            raw = i in special_ids or any(c not in byte_of for c in token)
            self.token_bytes.append(token.encode() if raw else bytes(byte_of[c] for c in token))
        self.decimal = [b"%d" % i for i in range(len(self.token_bytes))]
        self.alphabet = {byte: char for char, byte in byte_of.items()}
        self.model = self.tokenizer.model
        self.pieces = _Pieces(self)
        self.words = _Words(self)

    def plain(self, texts: list[str]) -> list[list[int]]:
        """Ids by the library itself."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Exact ids of whole texts, as bytes of little-endian 32-bit numbers.

        A space between two characters that are not white space starts a new piece whatever stands
        around it, so the words between such spaces encode independently.
        """
        out = []
        for text in texts:
            first, *words = text.split(" ")
            if any(s in text for s in self.specials):
                out.append(_blob(self.plain([text])[0]))
                continue
            try:
                out.append(self.cut(first) + b"".join(map(self.words.__getitem__, words)))
            except _NoWord:
                out.append(self.cut(text))
        return out

    def cut(self, text: str) -> bytes:
        """Encode a text in units: a run of letters, which may hold apostrophes and takes one space
        before it, or what stands between two such runs. Where the last characters of a unit read
        on into the letters that follow, both are encoded together."""
        units = UNITS.findall(text)
        try:
            return b"".join(map(self.pieces.__getitem__, units))
        except _NoUnit:
            pass
        if any(map(_odd_letters, units)):
            return _blob(self.plain([text])[0])
        ids, held = [], ""
        for unit in units:
            if held or _reads_on(unit):
                held += unit
                if not _reads_on(unit):
                    ids.append(_blob(self.plain([held])[0]))
                    held = ""
            else:
                ids.append(self.pieces[unit])
        return b"".join(ids) + (_blob(self.plain([held])[0]) if held else b"")

    def piece(self, unit: str) -> bytes:
        """A run of letters is one piece: it goes to the merges of the library directly."""
        body = unit.removeprefix(" ")
        if body.isalpha():
            if body.isascii():
                piece = unit if len(body) == len(unit) else "\u0120" + body
            else:
                piece = unit.encode().decode("latin-1").translate(self.alphabet)
            return _blob([t.id for t in self.model.tokenize(piece)])
        return _blob(self.plain([unit])[0])

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of two neighbouring texts put together, from the ids of each."""
        size = WINDOW_TOKENS
        while True:
            if len(left) <= size and len(right) <= size:
                return self._window(left, right)
            a, b = max(0, len(left) - size), min(len(right), size)
            while a > 0 and not self._starts_well(left, a):
                a -= 1
            while b < len(right) and not (
                self._starts_well(right, b) and not self.token_bytes[right[b - 1]][-1:].isspace()
            ):
                b += 1
            middle = self._window(left[a:], right[:b])
            start = self._agreed_start(left[a:], middle) if a else 0
            end = self._agreed_end(right[:b], middle) if b < len(right) else 0
            if start is not None and end is not None and start + end <= len(middle):
                return [*left[:a], *middle, *right[b:]]
            size *= 2

    def _starts_well(self, ids: list[int], i: int) -> bool:
        """Whether a window may begin or end before token `i`: at a character's first byte and not
        at an apostrophe, which reads differently at the start of a text."""
        first = self.token_bytes[ids[i]][0]
        return first & 0xC0 != 0x80 and first != 0x27

    def _window(self, left: list[int], right: list[int]) -> list[int]:
        raw = b"".join([self.token_bytes[i] for i in left] + [self.token_bytes[i] for i in right])
        return self.plain([raw.decode()])[0]

    def _agreed_start(self, old: list[int], new: list[int]) -> int | None:
        """Tokens at the left end of the window that the left side had too: two at least, and the
        last of them must end before the cut."""
        n = 0
        while n < min(len(old), len(new)) and old[n] == new[n]:
            n += 1
        n = min(n, len(old) - 1)
        return n if n >= 2 else None

    def _agreed_end(self, old: list[int], new: list[int]) -> int | None:
        n = 0
        while n < min(len(old), len(new)) and old[-1 - n] == new[-1 - n]:
            n += 1
        n = min(n, len(old) - 1)
        return n if n >= 2 else None

    def halves(self, text: str, leaf: int) -> list[str]:
        """The leaves of the tree, in order. A cut never falls inside a special token."""
        if len(text) <= leaf:
            return [text]
        cut = len(text) // 2
        for special in self.specials:
            at = text.find(special, max(0, cut - len(special) + 1), cut + len(special) - 1)
            if 0 <= at < cut < at + len(special):
                cut = at
        if not 0 < cut < len(text):
            return [text]
        return self.halves(text[:cut], leaf) + self.halves(text[cut:], leaf)

    def tree(self, leaves: list[bytes]) -> bytes:
        """Join neighbours level by level."""
        if len(leaves) == 1:
            return leaves[0]
        parts = [numbers(x) for x in leaves]
        while len(parts) > 1:
            joined = [self.join_texts(a, b) for a, b in zip(parts[::2], parts[1::2], strict=False)]
            parts = joined + parts[len(joined) * 2 :]
        return _blob(parts[0])

    def join_texts(self, left: list[int], right: list[int]) -> list[int]:
        """`join`, between the special tokens nearest to the cut: text beyond them is apart."""
        special = self.special_ids
        a = next((i + 1 for i in range(len(left) - 1, -1, -1) if left[i] in special), 0)
        b = next((i for i in range(len(right)) if right[i] in special), len(right))
        if a == len(left) or b == 0:
            return left + right
        return left[:a] + self.join(left[a:], right[:b]) + right[b:]

    @property
    def special_ids(self) -> frozenset[int]:
        if not hasattr(self, "_special_ids"):
            self._special_ids = frozenset(self.tokenizer.get_added_tokens_decoder())
        return self._special_ids

    def tree_encode(self, texts: list[str], leaf: int = LEAF_CHARS) -> list[bytes]:
        """Ids of whole texts, as bytes: leaves encoded on their own, then joined."""
        leaves = [self.halves(t, leaf) for t in texts]
        flat = iter(self.encode([x for one in leaves for x in one]))
        return [self.tree([next(flat) for _ in one]) for one in leaves]

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each Python worker, which Spark reuses over tasks."""
    return Encoder(path)


def text_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of about BATCH_CHARS bytes, by the column "text"."""
    for batch in batches:
        sizes = np.asarray(
            pc.fill_null(pc.binary_length(batch.column("text")), 0), np.int64
        )
        cuts = np.unique(np.cumsum(sizes) // BATCH_CHARS, return_index=True)[1] if len(sizes) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(sizes)], strict=True):
            yield batch.slice(lo, hi - lo)


#: Makes columns from doc_ids and the ids of their texts, which are bytes.
Finish = Callable[[Encoder, pa.Array, list[bytes]], list[pa.Array]]


def blobs(enc: Encoder, docs: pa.Array, rows: list[bytes]) -> list[pa.Array]:
    """The ids as bytes of little-endian 32-bit numbers."""
    return [pa.array(rows, pa.binary())]


def digests(enc: Encoder, docs: pa.Array, found: list[bytes]) -> list[pa.Array]:
    """Number of ids, SHA-256 of the decimal ids with commas, SHA-256 of the decoded text."""
    rows = [numbers(x) for x in found]
    ids = [hashlib.sha256(b",".join(map(enc.decimal.__getitem__, x))).hexdigest() for x in rows]
    texts = [hashlib.sha256(enc.decode(x).encode()).hexdigest() for x in rows]
    return [pa.array([len(x) for x in rows], pa.int64()), pa.array(ids), pa.array(texts)]


DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(
    docs: DataFrame, path: str, finish: Finish = blobs, finished: str = "ids binary"
) -> DataFrame:
    """doc_id and what `finish` makes of the ids of every text, by tree concatenation.

    NULL text counts as empty; an empty text has no ids. Texts of more than TASK_CHARS characters
    are cut into segments, which other tasks encode; their ids are joined in the task that finishes
    the whole text. Every row gives one row, also repeated ones and those with a NULL doc_id.
    """
    slim = importable(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    short = slim.filter(F.length("text") <= TASK_CHARS)
    long = slim.filter(F.length("text") > TASK_CHARS)
    schema = f"doc_id long, {finished}"
    names = [part.split()[0] for part in schema.split(", ")]

    def whole(batches):
        enc = encoder(path)
        for batch in text_batches(batches):
            ids = enc.tree_encode(batch.column("text").to_pylist())
            columns = [batch.column("doc_id"), *finish(enc, batch.column("doc_id"), ids)]
            yield pa.RecordBatch.from_arrays(columns, names)

    def cut(batches):
        enc = encoder(path)
        for batch in batches:
            for doc, row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                leaves = enc.halves(text, TASK_CHARS // 4)
                n = len(leaves)
                columns = [[doc] * n, [row] * n, list(range(n)), leaves]
                types = [pa.int64(), pa.int64(), pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    ["doc_id", "row", "at", "text"],
                )

    def leaves(batches):
        enc = encoder(path)
        for batch in text_batches(batches):
            ids = enc.tree_encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "row", "at")), pa.array(ids, pa.binary())],
                ["doc_id", "row", "at", "ids"],
            )

    def joined(leaves: pa.Table) -> pa.Table:
        enc = encoder(path)
        leaves = leaves.sort_by("at")
        doc = leaves.column("doc_id").slice(0, 1).combine_chunks()
        columns = [doc, *finish(enc, doc, [enc.tree(leaves.column("ids").to_pylist())])]
        return pa.table(columns, names)

    done = short.mapInArrow(whole, schema)
    # One row for each long text: `row` names it while its leaves are apart.
    pieces = (
        long.withColumn("row", F.monotonically_increasing_id())
        .select("doc_id", "row", "text")
        .mapInArrow(cut, "doc_id long, row long, at int, text string")
        .repartition("row", "at")
        .mapInArrow(leaves, "doc_id long, row long, at int, ids binary")
    )
    return done.unionByName(pieces.groupBy("row").applyInArrow(joined, schema))
