"""Byte-level BPE: encoding and decoding with a published vocabulary.

A text is cut into pieces by the vocabulary's pattern; each piece starts as its bytes and the
adjacent pair of lowest rank, leftmost first, is merged until no pair has a rank. The ranks of
the adjacent pairs are the leaves of a segment tree whose root is the next merge; a merge
changes three leaves, each in logarithmic time. Many short pieces are merged side by side, one
tree per row of a matrix; long ones get a tree of their own.

Texts are independent of each other: no shuffle, any row can be recomputed anywhere. A worker
holds the vocabulary, one batch and caches of bounded size.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara.llm import common

common.by_value(__name__)

#: Chunks, and pieces, that a task remembers.
CACHE = 450_000
#: Pieces of more bytes than this get a tree of their own.
LONG = 64
#: Leaves of all trees that are merged side by side.
_CELLS = 1 << 18
_NONE = np.int64(2**62)


# Letters and digits that came after Unicode 16, which the vocabulary's own
# library takes for neither (every code point is tested against it).
YOUNG = (
    r"\U00000558\U0000058B-\U0000058C\U0000088F\U00000C5C\U00000CDC\U0000208F"
    r"\U0000209D-\U0000209F\U0000A7CE-\U0000A7CF\U0000A7D2\U0000A7D4\U0000A7DD\U0000A7E2"
    r"\U0000A7F1\U0000AB6C-\U0000AB6D\U000107BB-\U000107BF\U00010940-\U00010959"
    r"\U00010EC5-\U00010EC7\U00010ED9-\U00010EEE\U00011B0A\U00011DB0-\U00011DDB\U00011DF1"
    r"\U00016EA0-\U00016EB8\U00016EBB-\U00016ED3\U00016FF2-\U00016FF3\U000187F8-\U000187FF"
    r"\U00018CD6-\U00018CDA\U00018D09-\U00018D20\U00018D80-\U00018DF2\U00018E00-\U00019191"
    r"\U000191A0-\U000191D2\U0001B123-\U0001B128\U0001B168\U0001D6A6\U0001DF1F-\U0001DF24"
    r"\U0001DF2B-\U0001DF81\U0001DF90-\U0001DF96\U0001DFCD-\U0001DFFF\U0001E6C0-\U0001E6DE"
    r"\U0001E6E0-\U0001E6E2\U0001E6E4-\U0001E6E5\U0001E6E7-\U0001E6ED\U0001E6F0-\U0001E6F4"
    r"\U0001E6FE-\U0001E6FF\U0002B73A-\U0002B73F\U0002B81E\U0002CEA2-\U0002CEAD"
    r"\U000323B0-\U00033479\U0003D000-\U0003FC3F"
    r"\U00011DE0-\U00011DE9\U0001246F\U00012475-\U0001247F\U00012550-\U00012686"
    r"\U00016FF4-\U00016FF6"
)


class _Known:
    """What a task remembers, in two generations: what is still asked for outlives the older one."""

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def missing(self, wanted: set[str]) -> list[str]:
        """Those that are not known; all others are among the young afterwards."""
        if len(self.young) + len(wanted) > CACHE // 2:
            self.old, self.young = self.young, {}
        young, old, out = self.young, self.old, []
        for key in wanted:
            if key not in young:
                found = old.get(key)
                if found is None:
                    out.append(key)
                else:
                    young[key] = found
        return out


class Vocabulary:
    """A byte-level BPE vocabulary in the JSON format of the tokenizers library."""

    def __init__(self, source: str) -> None:
        self.source = source

    def __getstate__(self) -> dict:
        """What tasks need, as arrays: a task has them at once, while reading the file takes a second."""
        tokens = self.tokens.tolist()
        return {"special": self.special, "byte_ids": self.byte_ids, "_ranked": self._ranked,
                "_shipped": (b"".join(tokens), [len(t) for t in tokens])}

    @cached_property
    def _content(self) -> dict:
        content = json.loads(self.source)
        before = content["pre_tokenizer"] or {}
        if (content["model"]["type"] != "BPE" or content["normalizer"] is not None
                or before.get("type") != "ByteLevel" or before.get("add_prefix_space")):
            raise ValueError("a byte-level BPE vocabulary without normalizer is needed")
        return content

    @cached_property
    def _bytes_of(self) -> dict[str, int]:
        """The printable character that stands for each byte in the file."""
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}

    @cached_property
    def ids(self) -> dict[bytes, int]:
        back = self._bytes_of
        return {bytes(back[c] for c in token): i for token, i in self._content["model"]["vocab"].items()}

    @cached_property
    def special(self) -> dict[str, int]:
        return {t["content"]: t["id"] for t in self._content["added_tokens"]}

    @cached_property
    def tokens(self) -> np.ndarray:
        """Bytes by id."""
        if "_shipped" in self.__dict__:
            raw, sizes = self._shipped
            ends = np.cumsum(sizes).tolist()
            out = np.empty(len(sizes), dtype=object)
            out[:] = [raw[e - n:e] for n, e in zip(sizes, ends)]
            return out
        out = np.full(max([*self.ids.values(), *self.special.values()]) + 1, b"", dtype=object)
        for token, i in self.ids.items():
            out[i] = token
        for text, i in self.special.items():
            out[i] = text.encode()
        return out

    @cached_property
    def merges(self) -> dict[tuple[int, int], tuple[int, int]]:
        """(left id, right id) -> (rank, id of the merged token)."""
        if "_shipped" in self.__dict__:
            keys, ranks, into = self._ranked
            return {(k >> 32, k & 0xFFFFFFFF): (r, i) for k, r, i in zip(keys.tolist(), ranks.tolist(), into[ranks].tolist())}
        back, ids, out = self._bytes_of, self.ids, {}
        for rank, pair in enumerate(self._content["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            a, b = (bytes(back[c] for c in half) for half in (left, right))
            out[ids[a], ids[b]] = rank, ids[a + b]
        return out

    @cached_property
    def byte_ids(self) -> np.ndarray:
        return np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int64)

    @cached_property
    def _ranked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pair keys in order, their ranks, and merged ids by rank."""
        keys = np.array([(a << 32) | b for a, b in self.merges], dtype=np.int64)
        ranks = np.array([r for r, _ in self.merges.values()], dtype=np.int64)
        order = np.argsort(keys)
        into = np.zeros(int(ranks.max()) + 1, dtype=np.int64)
        into[ranks] = [i for _, i in self.merges.values()]
        return keys[order], ranks[order], into

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``_NONE`` where it has none (an id of -1 stands for no token)."""
        keys, ranks, _ = self._ranked
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where((keys[at] == wanted) & (left >= 0) & (right >= 0), ranks[at], _NONE)

    # --- cutting into pieces -------------------------------------------------------------

    @cached_property
    def _patterns(self) -> tuple[regex.Pattern, regex.Pattern, regex.Pattern]:
        """The pattern, what it must not take for letters or digits, and the pattern without."""
        shape = r"'s|'t|'re|'ve|'m|'ll|'d| ?{}+| ?{}+| ?(?:{})+|\s+(?!\S)|\s+"
        plain = shape.format(r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]")
        exact = shape.format(rf"[\p{{L}}--[{YOUNG}]]", rf"[\p{{N}}--[{YOUNG}]]", rf"[^\s\p{{L}}\p{{N}}]|[{YOUNG}]")
        return regex.compile(plain, regex.V1), regex.compile(f"[{YOUNG}]"), regex.compile(exact, regex.V1)

    @cached_property
    def _uneven(self) -> regex.Pattern:
        """A space amid white space: there the pieces do not follow from the chunks alone."""
        return regex.compile(r"\s (?:\s|\Z)")

    @cached_property
    def _special_pattern(self) -> regex.Pattern | None:
        listed = sorted(self.special, key=len, reverse=True)
        return regex.compile("(" + "|".join(map(regex.escape, listed)) + ")") if listed else None

    def pieces(self, text: str) -> list[str]:
        plain, young, exact = self._patterns
        return (plain if text.isascii() or not young.search(text) else exact).findall(text)

    # --- merging -------------------------------------------------------------------------

    def merge_long(self, piece: bytes) -> list[int]:
        """One piece, with a segment tree over (rank, place) of its adjacent pairs."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n, merges = len(ids), self.merges
        width = 1 << max(0, (n - 1).bit_length())
        none = (len(merges) + 1, 0)
        tree = [none] * (2 * width)

        def rank(i: int, j: int) -> tuple[int, int]:
            found = merges.get((ids[i], ids[j])) if j < n else None
            return (found[0], i) if found else none

        for i in range(n - 1):
            tree[width + i] = rank(i, i + 1)
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])

        def put(i: int, value: tuple[int, int]) -> None:
            k = width + i
            tree[k] = value
            while k > 1:
                k >>= 1
                low = min(tree[2 * k], tree[2 * k + 1])
                if tree[k] == low:
                    break
                tree[k] = low

        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while tree[1] != none:
            i = tree[1][1]
            j = after[i]
            ids[i] = merges[ids[i], ids[j]][1]
            ids[j] = -1
            after[i] = after[j]
            put(j, none)
            if after[i] < n:
                before[after[i]] = i
            put(i, rank(i, after[i]))
            if before[i] >= 0:
                put(before[i], rank(before[i], i))
        return [i for i in ids if i >= 0]

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (as int32 bytes) of pieces of at most ``LONG`` bytes: a tree in each row."""
        out: list[bytes] = [b""] * len(pieces)
        by_width: dict[int, list[int]] = {}
        for at, piece in enumerate(pieces):
            by_width.setdefault(1 << max(1, (len(piece) - 1).bit_length()), []).append(at)
        for width, places in by_width.items():
            step = max(1, _CELLS // width)
            for some in (places[i:i + step] for i in range(0, len(places), step)):
                ids = self._forest([pieces[at] for at in some], width)
                kept = ids >= 0
                flat, ends = ids[kept].astype("<i4").tobytes(), np.cumsum(kept.sum(1)) * 4
                for at, begin, end in zip(some, [0, *ends[:-1].tolist()], ends.tolist()):
                    out[at] = flat[begin:end]
        return out

    def _forest(self, pieces: list[bytes], width: int) -> np.ndarray:
        m, into = len(pieces), self._ranked[2]
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(m, width)
        place = np.arange(width)
        lengths = np.array([len(p) for p in pieces])
        ids = np.where(place < lengths[:, None], self.byte_ids[raw], -1)
        # one column more, for the token after the last: none
        ids = np.concatenate([ids, np.full((m, 1), -1)], axis=1)
        after = np.tile(np.minimum(place + 1, width), (m, 1))
        before = np.tile(np.append(place - 1, 0), (m, 1))
        tree = np.full((m, 2 * width), _NONE)
        first = self.ranks(ids[:, :-1], ids[:, 1:])
        tree[:, width:] = np.where(first < _NONE, first * width + place, _NONE)
        for k in range(width - 1, 0, -1):
            tree[:, k] = np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1])

        def put(rows: np.ndarray, at: np.ndarray, ranks: np.ndarray) -> None:
            k = width + at
            tree[rows, k] = np.where(ranks < _NONE, ranks * width + at, _NONE)
            for _ in range(width.bit_length() - 1):
                k >>= 1
                tree[rows, k] = np.minimum(tree[rows, 2 * k], tree[rows, 2 * k + 1])

        rows = np.flatnonzero(tree[:, 1] < _NONE)
        while len(rows):
            root = tree[rows, 1]
            at = root % width
            gone = after[rows, at]
            new = after[rows, gone]
            ids[rows, at] = into[root // width]
            ids[rows, gone] = -1
            after[rows, at] = new
            before[rows, new] = at
            put(rows, gone, np.full(len(rows), _NONE))
            put(rows, at, self.ranks(ids[rows, at], ids[rows, new]))
            left = at > 0
            some, prior = rows[left], before[rows, at][left]
            put(some, prior, self.ranks(ids[some, prior], ids[some, at[left]]))
            rows = rows[tree[rows, 1] < _NONE]
        return ids[:, :width]

    # --- whole texts ---------------------------------------------------------------------

    @cached_property
    def _chunk_ids(self) -> _Known:
        return _Known()

    @cached_property
    def _piece_ids(self) -> _Known:
        return _Known()

    def _learn(self, chunks: list[str]) -> None:
        """Remember the ids of chunks."""
        cut = {chunk: self.pieces(chunk) for chunk in chunks}
        new = self._piece_ids.missing(set(chain.from_iterable(cut.values())))
        pieces, known = self._piece_ids.young, self._chunk_ids.young
        raw = [p.encode() for p in new]
        short = [i for i, p in enumerate(raw) if len(p) <= LONG]
        for i, ids in zip(short, self.merge_many([raw[i] for i in short])):
            pieces[new[i]] = ids
        for p, b in zip(new, raw):
            if len(b) > LONG:
                pieces[p] = np.array(self.merge_long(b), dtype="<i4").tobytes()
        for chunk, parts in cut.items():
            known[chunk] = pieces[parts[0]] if len(parts) == 1 else b"".join([pieces[p] for p in parts])

    def _chunks(self, text: str) -> list[str]:
        """Parts whose ids joined are the ids of the text: what stands between spaces, with the
        space before it."""
        if not text:
            return []
        if self._uneven.search(text):
            return self.pieces(text)
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + r for r in rest]

    def _parts(self, text: str) -> Iterator[tuple[list[str], bytes]]:
        """Chunks, then the id of the special token after them."""
        if self._special_pattern is None:
            yield self._chunks(text), b""
            return
        cut = self._special_pattern.split(text)
        for i in range(0, len(cut), 2):
            token = self.special[cut[i + 1]].to_bytes(4, "little") if i + 1 < len(cut) else b""
            yield self._chunks(cut[i]), token

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as int32 bytes."""
        out, group, held = [], [], 0
        for text in texts:
            group.append(text)
            held += len(text)
            if held >= 1 << 20:  # chunks of about a million characters are looked up at once
                out += self._encode(group)
                group, held = [], 0
        return out + self._encode(group)

    def _encode(self, texts: list[str]) -> list[bytes]:
        cut = [list(self._parts(text)) for text in texts]
        self._learn(self._chunk_ids.missing(set(chain.from_iterable(chunks for parts in cut for chunks, _ in parts))))
        known = self._chunk_ids.young
        return [b"".join(chain.from_iterable(chain(map(known.__getitem__, chunks), (token,))
                                             for chunks, token in parts)) for parts in cut]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens, special ones included."""
        return b"".join(self.tokens[ids].tolist())


def load(path: str) -> Vocabulary:
    """Read the vocabulary on the driver; the tasks get its content (1.5 MB)."""
    with open(path, encoding="utf-8") as file:
        return Vocabulary(file.read())


def _lists(ids: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids], dtype=np.int64)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                    pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32()))


def encode(text: Column, vocabulary: Vocabulary) -> Column:
    """Token ids (``array<int>``) of a text column; a null text is empty."""

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield _lists(vocabulary.encode_batch([t or "" for t in texts.to_pylist()]))

    return ids(text)


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """Text of an ``array<int>`` column of token ids; bytes that are no UTF-8 become U+FFFD,
    null ids an empty text."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            yield pa.array([vocabulary.decode(flat[e - n:e]).decode("utf-8", "replace")
                            for n, e in zip(sizes, ends)], pa.string())

    return text(ids)


def encode_table(docs: DataFrame, vocabulary: Vocabulary, text: str = "text",
                 ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """The rows with their token ids and, if a name is given, what the ids decode to.

    Every row stays, repeated ones too; null and empty texts have no ids; other columns are
    left alone, one named like an output is replaced.
    """
    out = common.tuned(docs).withColumn(ids, encode(F.col(text), vocabulary))
    return out if decoded is None else out.withColumn(decoded, decode(F.col(ids), vocabulary))
