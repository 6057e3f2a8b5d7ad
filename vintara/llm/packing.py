"""Packing documents into sequences by hierarchical multi-length packing.

There are several context sizes, each a power of two. A document gives whole windows of the largest
size; what is left of it belongs to the tier of the smallest size that holds it. Tiers are packed
from the largest down: every piece opens a window, whose gap is filled with the largest pieces of
shorter tiers that fit, the last of which is cut to fit. So windows are full, and the few tokens a
task has in the end go into windows of falling powers of two. Windows of one size and of similar
attention cost make up a step group, and all groups have the same number of tokens but the last of
a task.

A task packs the documents it reads and moves nothing: it holds one batch, a pool of some hundred
thousand tokens and the windows that wait for their step group. The same input files give the same
sequences, also where a task is run again.

Texts are tokenised by the library whose file is given, each distinct word once.

Odd rows: a null or empty text is the end token alone; rows of one id, or without one, are documents
of their own; long texts give many windows. Empty tables give no rows. Only the id and the text are
read, so other columns may have any names.
"""

from __future__ import annotations

import sys
import types
from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintara.llm import common

common.by_value(__name__)

#: Context sizes, powers of two.
TIERS = (256, 512, 1024, 2048, 4096)
#: Tokens of a step group.
STEP = 16 * 4096
#: Tokens waiting to be packed, and distinct cuts that a worker remembers.
POOL, CACHE = 1 << 19, 600_000
#: Cuts longer than this are not remembered; cuts are encoded in groups of that many characters.
LONG, GROUP = 256, 1 << 15
_PIECES = ("doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, "
           "window long, step_group long")

Piece = tuple[int | None, int, int, bytes]  # document, its tokens, start, ids of 4 bytes each


class Encoder:
    """Token ids of whole texts by a file of the tokenizers library.

    A text is cut where white space stands. Cuts of ASCII and Latin-1 letters alone, whose case
    the library ignores, are taken in lower case and cut further between letters and others, where
    its pattern cuts too (but not after an apostrophe, which may begin a contraction). Every
    distinct cut is encoded once and remembered.
    """

    def __init__(self, content: str, end: int) -> None:
        self.content, self.end, self.tokenizer = content, end, None
        self._forget()

    def __reduce__(self):
        return Encoder, (self.content, self.end)

    def _forget(self) -> None:
        """Only the end token is known, as number 0."""
        self.codes: dict[str, int] = {}
        self.ids, self.sizes = np.array([self.end], np.uint32), np.ones(1, np.int64)

    def _open(self) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(self.content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # the same model, for cuts that nothing normalises and the pattern leaves whole
        self.plain = Tokenizer.from_str(self.content)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def _encode(self, cuts: list[str]) -> Iterator[list[int]]:
        """Ids of each cut; cuts of small ASCII and Latin-1 letters, nearly all, go straight to the model."""
        if self.tokenizer is None:
            self._open()
        plain = [c.isalpha() and c == c.lower() and (c.isascii() or max(c) < "\u0100") for c in cuts]
        short = iter(self.plain.encode_batch_fast([c for c, p in zip(cuts, plain) if p], add_special_tokens=False))
        other = iter(self.tokenizer.encode_batch_fast([c for c, p in zip(cuts, plain) if not p], add_special_tokens=False))
        return (next(short if p else other).ids for p in plain)

    def numbers(self, cuts: list[str]) -> np.ndarray:
        """A number for each of the distinct cuts, by which its ids are found."""
        known = self.codes.get
        out = np.array([known(c, -1) for c in cuts], np.int64)
        missing = np.flatnonzero(out < 0)
        ids, sizes = [self.ids], [self.sizes]
        group: list[str] = []
        held = 0
        for i in missing.tolist():
            group.append(cuts[i])
            held += len(cuts[i])
            if held >= GROUP or i == missing[-1]:
                found = list(self._encode(group))
                ids.append(np.fromiter(chain.from_iterable(found), np.uint32))
                sizes.append(np.fromiter(map(len, found), np.int64))
                group, held = [], 0
        out[missing] = np.arange(len(missing)) + len(self.sizes)
        for i, number in zip(missing.tolist(), out[missing].tolist()):
            if len(cuts[i]) <= LONG:
                self.codes[cuts[i]] = number
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)
        return out

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with the end token, and where each text's ids end."""
        if len(self.sizes) > CACHE or len(self.ids) > 8 * CACHE:
            self._forget()
        flat = texts.fill_null("").cast(pa.large_binary())
        bounds = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
        low, high = (int(bounds[0]), int(bounds[-1])) if len(flat) else (0, 0)
        raw = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[low:high]
        begins, left, lower = _cuts(raw, bounds - low)
        at = np.flatnonzero(begins)
        kept = lower[left]
        offsets = np.append(np.flatnonzero(begins[left]), len(kept))
        cuts = pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
        coded = cuts.dictionary_encode()
        numbers = self.numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        # number 0, the end token, after the last cut of each text
        numbers = np.insert(numbers, np.searchsorted(at, bounds[1:] - low), 0)
        first = np.cumsum(self.sizes) - self.sizes
        each = self.sizes[numbers]
        ends = np.cumsum(each)
        out = self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[numbers] - (ends - each), each)]
        return out, ends[numbers == 0]


def _kept(encoder: Encoder) -> Encoder:
    """The encoder of this Python worker: its later tasks know the words of earlier ones."""
    here = sys.modules.setdefault("_packing_encoder", types.ModuleType("_packing_encoder"))
    known = getattr(here, "encoder", None)
    if known is None or (known.content, known.end) != (encoder.content, encoder.end):
        here.encoder = encoder
    return here.encoder


def _cuts(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes begin a cut, which belong to one, and the bytes with plain cuts in lower case."""
    n = len(raw)
    byte = np.arange(256)
    kinds = np.zeros(256, np.uint8)  # 1 white space, 2 ASCII letter, 4 none of ASCII, 8 apostrophe
    kinds[[*range(9, 14), 32]], kinds[39], kinds[128:] = 1, 8, 4
    kinds[((byte | 32) >= 97) & ((byte | 32) <= 122) & (byte < 128)] = 2
    kind = kinds[raw]
    blank, letter, other = kind == 1, kind == 2, kind == 4
    # U+00C0 to U+00FF but for the signs of multiplication and division: a letter of two bytes
    lead = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] != 0x97) & (raw[1:] != 0xB7))
    lower = raw.copy()
    lower[letter] |= 32
    capital = lead[raw[lead + 1] < 0x9F] + 1
    lower[capital] += 32
    for at in (lead, lead + 1):
        letter[at], other[at] = True, False
    # other characters, and what may be a special token, are left as they are
    other[:-1] |= (raw[:-1] == 60) & (raw[1:] == 124)
    begins = ~blank
    begins[1:] &= blank[:-1]
    begins[bounds[:-1][bounds[:-1] < n]] = True
    begins &= ~blank
    starts = np.flatnonzero(begins)
    if not len(starts):
        return begins, ~blank, lower
    plain = ~np.logical_or.reduceat(other, starts)
    plain = np.repeat(plain, np.diff(np.append(starts, n)))
    plain = np.concatenate([np.zeros(n - len(plain), bool), plain])
    lower = np.where(plain, lower, raw)
    turn = letter[1:] != letter[:-1]
    turn &= ~(letter[1:] & (kind[:-1] == 8)) & plain[1:] & ~blank[1:]
    begins[1:] |= turn
    return begins, ~blank, lower


class Packer:
    """Windows of one task."""

    def __init__(self, task: int, tiers: Sequence[int], step: int) -> None:
        self.tiers, self.step = sorted(tiers), step
        self.next_sequence = self.next_step = task << 33
        self.by_length: dict[int, list[Piece]] = defaultdict(list)
        self.lengths, self.held, self.fresh = 0, 0, 0  # a bit for each length in the pool; tokens in it; tokens not packed yet
        self.waiting: dict[int, list[list[Piece]]] = defaultdict(list)
        self.rows: list[tuple] = []

    # --- the pool ------------------------------------------------------------------------

    def _put(self, piece: Piece) -> None:
        n = len(piece[3]) // 4
        self.by_length[n].append(piece)
        self.lengths |= 1 << n
        self.held += n

    def _pop(self, n: int) -> Piece:
        same = self.by_length[n]
        piece = same.pop()
        if not same:
            self.lengths ^= 1 << n
        self.held -= n
        return piece

    def _largest(self, most: int) -> int:
        """Length of the largest piece up to ``most`` tokens, 0 if there is none."""
        return max(0, (self.lengths & (2 << most) - 1).bit_length() - 1)

    def _smallest(self, least: int, most: int) -> int:
        """Length of the smallest piece of ``least`` to ``most`` tokens, 0 if there is none."""
        some = (self.lengths & (2 << most) - 1) >> least
        return least + (some & -some).bit_length() - 1 if some else 0

    # --- windows -------------------------------------------------------------------------

    def add(self, doc: int | None, ids: np.ndarray) -> None:
        total, top = len(ids), self.tiers[-1]
        raw = ids.tobytes()
        whole = total - total % top
        self.fresh += total
        for start in range(0, whole, top):
            self.waiting[top].append([(doc, total, start, raw[4 * start:4 * (start + top)])])
        if total > whole:
            self._put((doc, total, whole, raw[4 * whole:]))

    def _filled(self, tier: int, below: int) -> bool:
        """Make one window of a piece of the tier; False if there is too little to fill it."""
        n = self._largest(tier)
        window, gap = [self._pop(n)], tier - n
        while gap:
            n = self._largest(min(gap, below or tier))
            if n:
                window.append(self._pop(n))
                gap -= n
                continue
            n = self._smallest(gap + 1, below or tier) or self._smallest(gap + 1, tier)
            if not n:
                n = self._largest(gap)
                if not n:
                    break
                window.append(self._pop(n))
                gap -= n
                continue
            doc, total, start, raw = self._pop(n)
            window.append((doc, total, start, raw[:4 * gap]))
            self._put((doc, total, start + gap, raw[4 * gap:]))
            gap = 0
        if gap:
            for piece in window:
                self._put(piece)
            return False
        self.waiting[tier].append(window)
        return True

    def pack(self) -> None:
        """Pack what the pool allows, tiers from the largest down, and hand out full step groups."""
        self.fresh = 0
        for at in range(len(self.tiers) - 1, -1, -1):
            tier, below = self.tiers[at], self.tiers[at - 1] if at else 0
            while self._largest(tier) > below and self._filled(tier, below):
                pass
        for tier, windows in self.waiting.items():
            per = max(1, self.step // tier)
            windows.sort(key=lambda w: sum(len(p[3]) ** 2 for p in w), reverse=True)
            for i in range(0, len(windows) - per + 1, per):
                self._hand_out(tier, windows[i:i + per])
            del windows[:len(windows) - len(windows) % per]

    def _hand_out(self, tier: int, windows: list[list[Piece]], last: bool = True) -> None:
        for window in windows:
            offset = 0
            for doc, total, start, raw in window:
                n = len(raw) // 4
                self.rows.append((doc, start, n, raw, total, self.next_sequence, offset, tier, self.next_step))
                offset += n
            self.next_sequence += 1
        self.next_step += last

    def finish(self) -> None:
        """Pack the rest into windows of falling powers of two, and what waits into step groups."""
        self.pack()
        rest = self.held
        size = self.tiers[-1]
        while rest:
            while size > rest:
                size //= 2
            window, gap = [], size
            while gap:
                doc, total, start, raw = self._pop(self._largest(self.tiers[-1]))
                window.append((doc, total, start, raw[:4 * gap]))
                if len(raw) > 4 * gap:
                    self._put((doc, total, start + gap, raw[4 * gap:]))
                gap -= min(gap, len(raw) // 4)
            self.waiting[size].append(window)
            rest -= size
        # sizes fall by powers of two, so every group but the last is filled to the token
        room = self.step
        for tier in sorted(self.waiting, reverse=True):
            for window in self.waiting.pop(tier):
                room -= tier
                self._hand_out(tier, [window], last=room <= 0)
                room = self.step if room <= 0 else room

    def batch(self) -> pa.RecordBatch:
        columns, self.rows = list(zip(*self.rows)) or [()] * 9, []
        kinds = [pa.binary() if i == 3 else pa.int64() for i in range(9)]
        names = [c.split()[0] for c in _PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def pack(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = 2,
         tiers: Sequence[int] = TIERS, step: int = STEP) -> DataFrame:
    """A row per piece of a document: its ids as 4 little-endian bytes each, and its place.

    ``tokenizer`` is the path of a file of the tokenizers library, read on the driver; ``end`` is put
    after every document. ``sequence_id``, ``offset`` and ``window`` (its size) say where the piece is,
    ``step_group`` which sequences are trained on together.
    """
    with open(tokenizer, encoding="utf-8") as file:
        encoder = Encoder(file.read(), end)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, packer = _kept(encoder), Packer(TaskContext.get().partitionId(), tiers, step)
        for batch in batches:
            # a few rows at a time: token ids take more room than text
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                ids, ends = known.texts(rows.column(1))
                for doc, start, stop in zip(rows.column(0).to_pylist(), [0, *ends.tolist()], ends.tolist()):
                    packer.add(doc, ids[start:stop])
                    if packer.fresh >= POOL:
                        packer.pack()
                        yield packer.batch()
        packer.finish()
        yield packer.batch()

    rows = common.tuned(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(packed, _PIECES)
