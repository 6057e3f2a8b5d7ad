"""SimHash near-duplicates by anchor-point covering.

Two fingerprints of 64 bits that differ in at most ``distance`` bits differ in at most
``distance // blocks`` of one of ``blocks`` runs of bits. Within a run, the words of a covering
code are the anchors: every value is within the covering radius (1) of an anchor, its home. A
value goes to every anchor within the radius plus the run's distance, so it meets each value
near it at that value's home. Fingerprints are compared in full at each anchor.

The code of a run is given by a parity check of ``checks`` rows whose columns take every value
but zero: then each syndrome is a column, and flipping that one bit leads to a code word.

Equal texts and equal fingerprints meet once, as one row. An anchor with many members is dealt
out into cells of bounded size in which every home still meets every member. A cell gives the
links of a spanning forest only, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintara.llm import common
from vintara.llm.components import components
from vintara.operators.joins import lookup_join
from vintara.session import settle

common.by_value(__name__)

#: Members of a cell, on average, before an anchor is dealt out further.
CELL = 4096
#: Hot anchors up to which their list (12 bytes each) is sent to the tasks.
HOT = 100_000
#: Pairs compared at a time, and shingles counted at a time.
_PAIRS, _SHINGLES = 1 << 20, 1 << 16
#: What a row is in its cell.
BOTH, HOME, MEMBER = 0, 1, 2


# --- fingerprints ------------------------------------------------------------------------


def _fingerprint(text: bytes, shingle: int, seed: int) -> int:
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    width = min(shingle, len(words))
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(words) - width + 1
    starts = [0, *ends]
    for at in range(0, n, _SHINGLES):
        spans = zip(starts[at:min(at + _SHINGLES, n)], ends[at + width - 1:])
        hashes = np.array([digest(joined[s:e - 1], seed) for s, e in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    """SimHash of the text's word shingles as a signed long.

    A-Z count as lower case; words are runs without ASCII white space; repeated shingles count
    again; a text of fewer words is one shingle, one without words (or null) has zero.
    """

    @F.arrow_udf("long")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([_fingerprint(t or b"", shingle, seed) for t in texts.cast(pa.binary()).to_pylist()],
                           pa.int64())

    return prints(text)


# --- anchors -----------------------------------------------------------------------------


def runs(blocks: int) -> list[tuple[int, int]]:
    """(first bit, width) of each run of bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def flips(width: int, checks: int, within: int) -> tuple[list[int], list[list[int]]]:
    """The parity check's rows as bit masks, and for each syndrome the flips of at most
    ``within`` bits that lead to a code word, the shortest one first."""
    columns = [i % (2 ** checks - 1) + 1 for i in range(width)]
    if width < 2 ** checks - 1:
        raise ValueError("the code covers with radius 1 only if its columns take every value")
    rows = [sum(1 << i for i, c in enumerate(columns) if c >> j & 1) for j in range(checks)]
    by: list[list[int]] = [[] for _ in range(2 ** checks)]
    for n in range(within + 1):
        for some in combinations(range(width), n):
            by[reduce(lambda s, i: s ^ columns[i], some, 0)].append(sum(1 << i for i in some))
    return rows, by


def _anchor(value: Column, block: int):
    return lambda mask, i: F.struct((value.bitwiseXOR(mask) + F.lit(block << 56)).alias("anchor"),
                                    (i == 0).alias("home"))


def anchors(fp: Column, distance: int, blocks: int, checks: int) -> Column:
    """Array of (anchor, home) of a fingerprint: the code words near each of its runs."""
    near, found = distance // blocks, []
    for block, (first, width) in enumerate(runs(blocks)):
        rows, by = flips(width, checks, 1 + near)
        value = F.shiftrightunsigned(fp, first).bitwiseAND(F.lit((1 << width) - 1))
        syndrome = reduce(lambda a, b: a + b, [
            F.bit_count(value.bitwiseAND(F.lit(r))).bitwiseAND(F.lit(1)) * (1 << j) for j, r in enumerate(rows)])
        table = F.array(*[F.array(*[F.lit(m).cast("long") for m in masks]) for masks in by])
        masks = F.element_at(table, (syndrome + 1).cast("int"))
        found.append(F.transform(masks, _anchor(value, block)))
    return F.concat(*found)


# --- comparing ---------------------------------------------------------------------------


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the trees of each pair (a, b) in the forest ``label`` of roots, in place."""
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while not np.array_equal(up := label[label], label):
            label[:] = up


def cell_forest(starts: np.ndarray, sizes: np.ndarray, homes: np.ndarray, near) -> np.ndarray:
    """Root of every row after each home row was compared with all rows of its cell.

    ``starts`` and ``sizes`` give the cell of each home; ``near(i, j)`` tells which pairs link.
    """
    label = np.arange(int((starts + sizes).max()) if len(homes) else 0)
    at = 0
    while at < len(homes):
        ends = np.cumsum(sizes[at:])
        upto = at + max(1, int(np.searchsorted(ends, _PAIRS, "right")))
        n = sizes[at:upto]
        left = np.repeat(homes[at:upto], n)
        right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[at:upto], n)
        hit = near(left, right)
        join_labels(label, left[hit], right[hit])
        at = upto
    return label


def whole_cells(batches: Iterator[pa.RecordBatch], least: int = 1 << 16) -> Iterator[pa.Table]:
    """Tables that end where a cell ends, of rows sorted by (anchor, sub)."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        table = pa.Table.from_batches(held)
        anchor, sub = (table.column(n).to_numpy() for n in ("anchor", "sub"))
        changes = np.flatnonzero((anchor[1:] != anchor[:-1]) | (sub[1:] != sub[:-1]))
        if len(changes):
            cut = int(changes[-1]) + 1
            yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
            rows = table.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def cells_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(homes, first row of each home's cell, its size)."""
    anchor, sub = (table.column(n).to_numpy() for n in ("anchor", "sub"))
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (sub[1:] != sub[:-1])
    begins = np.flatnonzero(new)
    cell, sizes = np.cumsum(new) - 1, np.diff(np.append(begins, len(anchor)))
    homes = np.flatnonzero(table.column("role").to_numpy() != MEMBER)
    return homes, begins[cell[homes]], sizes[cell[homes]]


def _compare(distance: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_cells(batches):
            fp = table.column("fp").to_numpy().view(np.uint64)
            homes, starts, sizes = cells_of(table)
            label = cell_forest(starts, sizes, homes, lambda i, j: np.bitwise_count(fp[i] ^ fp[j]) <= distance)
            here = np.arange(len(label))
            linked = fp[here] != fp[label]
            yield pa.RecordBatch.from_pydict({"a": fp[here[linked]].view(np.int64), "b": fp[label[linked]].view(np.int64)})

    return compare


def dealt(members: DataFrame, cell: int = CELL) -> DataFrame:
    """Rows (anchor, home, ...) with ``sub``, the cell of their anchor, and ``role`` there, sorted
    for comparing.

    An anchor of up to ``cell`` rows is one cell, whose homes are members too. A larger one has
    n * n cells: homes are dealt into n parts, each met by each of n parts of the members.
    """
    hot = members.groupBy("anchor").agg(F.count("*").alias("_n")).where(F.col("_n") > cell)
    hot = settle(hot.select("anchor", F.ceil(F.col("_n") / cell).cast("int").alias("_parts")))
    n_hot = hot.count()
    keys = [c for c in members.columns if c not in ("anchor", "home")]
    # anchors are hot in the rare case: all members are moved for them only if they are very many
    rows = members.join(F.broadcast(hot), "anchor", "left") if n_hot <= HOT else lookup_join(members, hot, ["anchor"], "left")
    rows = rows.withColumn("_part", F.coalesce(
        F.pmod(F.xxhash64(*keys), F.col("_parts")).cast("int"), F.lit(0)))
    every = F.sequence(F.lit(0), F.col("_parts") - 1)
    homes = F.transform(every, lambda j: F.struct((F.col("_part") * F.col("_parts") + j).alias("sub"),
                                                  F.lit(HOME).alias("role")))
    spread = F.concat(
        F.when(F.col("home"), homes).otherwise(F.array().cast("array<struct<sub:int,role:int>>")),
        F.transform(every, lambda i: F.struct((i * F.col("_parts") + F.col("_part")).alias("sub"),
                                              F.lit(MEMBER).alias("role"))))
    single = F.array(F.struct(F.lit(0).alias("sub"), F.when(F.col("home"), BOTH).otherwise(MEMBER).alias("role")))
    rows = rows.withColumn("_cell", F.explode(F.when(F.col("_parts").isNull(), single).otherwise(spread)))
    return rows.select("anchor", "_cell.sub", "_cell.role", *keys).repartition("anchor", "sub").sortWithinPartitions(
        "anchor", "sub")


def links(prints: DataFrame, distance: int = 4, blocks: int = 3, checks: int = 4) -> DataFrame:
    """Spanning links (a, b) of the distinct fingerprints in column ``fp``, with repeats."""
    members = prints.select("fp", F.explode(anchors(F.col("fp"), distance, blocks, checks)).alias("_at")).select(
        "_at.anchor", "_at.home", "fp")
    return dealt(members).mapInArrow(_compare(distance), "a long, b long")


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
            distance: int = 4) -> tuple[DataFrame, DataFrame]:
    """(``doc_id``, ``h``, ``fp`` of each row; ``fp``, ``root`` and ``least``, the smallest
    (no id, id, hash of the text) of a fingerprint). Fingerprints of one group have one root."""
    slim = settle(common.tuned(docs).select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"),
        fingerprint(F.col(text), shingle).alias("fp")))
    prints = settle(slim.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("least")))
    roots = components(links(prints, distance)).withColumnRenamed("node", "fp")
    return slim, settle(lookup_join(prints, roots, ["fp"], "left").withColumn("root", F.coalesce("root", "fp")))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
                    distance: int = 4) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id``, a row for each row of the documents.

    Documents link if their fingerprints differ in at most ``distance`` bits; ``component_id`` is
    the smallest id reachable (null only if no document there has one). Null and empty texts have
    fingerprint zero and link like any other; rows that repeat an id are compared each by itself.
    """
    slim, rooted = grouped(docs, doc_id, text, shingle, distance)
    least = rooted.groupBy("root").agg(F.min("least").alias("first"))
    named = lookup_join(rooted.select("fp", "root"), least, ["root"], "left").select("fp", F.col("first.doc_id").alias("component_id"))
    return lookup_join(slim, named, ["fp"], "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
                    distance: int = 4) -> DataFrame:
    """(``doc_id``, ``h``) of the one document that stays of each group: its smallest id, null last,
    and of rows that share it the text that hashes lowest."""
    _, rooted = grouped(docs, doc_id, text, shingle, distance)
    return rooted.groupBy("root").agg(F.min("least").alias("first")).select("first.doc_id", "first.h")
